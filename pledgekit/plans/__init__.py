from pledgekit.plans.campaigns import clean, featurise
from pledgekit.plans.segmentation import Segments, segment
from pledgekit.plans.supervised import Supervised, train_and_evaluate

__all__ = ["Segments", "Supervised", "clean", "featurise", "segment", "train_and_evaluate"]
