"""Campaign analytics as composable Spark DataFrame operators."""

from pledgekit.spec import CampaignSpec, ClusterSpec, FeatureSpec, ModelSpec, SplitSpec

__all__ = ["CampaignSpec", "ClusterSpec", "FeatureSpec", "ModelSpec", "SplitSpec"]
