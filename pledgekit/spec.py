"""Declared column roles and parameters; operators never hard-code a column name."""

from __future__ import annotations

from dataclasses import dataclass

# The published campaign-table conventions.
FINAL_STATES = ("successful", "failed")
GOAL_BANDS = (("micro", 1_000.0), ("small", 10_000.0), ("medium", 50_000.0), ("large", 100_000.0))
TOP_BAND = "mega"


@dataclass(frozen=True)
class CampaignSpec:
    """Roles of the columns of a campaign table."""

    key: str = "ID"
    name: str = "name"
    category: str = "category"
    main_category: str = "main_category"
    currency: str = "currency"
    country: str = "country"
    state: str = "state"
    goal: str = "goal"
    pledged: str = "pledged"
    backers: str = "backers"
    launched: str = "launched"
    deadline: str = "deadline"
    usd_pledged: str = "usd_pledged_real"
    usd_goal: str = "usd_goal_real"
    success_state: str = "successful"
    final_states: tuple[str, ...] = FINAL_STATES
    launched_format: str = "yyyy-MM-dd HH:mm:ss"
    deadline_format: str = "yyyy-MM-dd"
    defaults: tuple[tuple[str, str], ...] = (("name", "Unknown"),)
    goal_bands: tuple[tuple[str, float], ...] = GOAL_BANDS
    top_band: str = TOP_BAND

    @property
    def critical(self) -> tuple[str, ...]:
        return (self.key, self.goal, self.launched, self.pledged, self.state, self.backers)

    @property
    def amounts(self) -> tuple[str, ...]:
        """Columns profiled for spread and outliers."""
        return (self.goal, self.pledged, self.backers, self.usd_pledged, self.usd_goal)


# Published names of the derived columns.
ENGINEERED = (
    "campaign_duration_days",
    "launch_month",
    "launch_day_of_week",
    "funding_ratio",
    "goal_bucket",
    "is_overfunded",
)


@dataclass(frozen=True)
class FeatureSpec:
    """Feature groups of the supervised models.

    ``temporal`` pairs a column with its declared number of levels (months 0-12, weekdays 0-7), so
    vector widths do not depend on which months a training split happens to hold. With
    ``compact_temporal`` the columns are shifted to start at 0, which removes the slot no calendar
    value can reach. ``high_card_encoding="onehot"`` avoids feeding frequency ranks to linear models.
    """

    continuous: tuple[str, ...] = ("goal", "usd_goal_real", "campaign_duration_days")
    high_card: tuple[str, ...] = ("category", "currency", "country")
    low_card: tuple[str, ...] = ("main_category", "goal_bucket")
    temporal: tuple[tuple[str, int], ...] = (("launch_month", 13), ("launch_day_of_week", 8))
    engagement: tuple[str, ...] = ("backers",)
    withheld: tuple[str, ...] = ("pledged", "usd_pledged_real", "funding_ratio", "is_overfunded")
    label: str = "label"
    target: str = "pledged_log"
    drop_last: bool = True
    compact_temporal: bool = False
    high_card_encoding: str = "index"

    @property
    def indexed(self) -> tuple[str, ...]:
        return self.high_card + self.low_card

    @property
    def inputs(self) -> tuple[str, ...]:
        """Launch-time columns shared by both tasks."""
        return self.continuous + self.indexed + tuple(c for c, _ in self.temporal)

    @property
    def classifier_vector(self) -> str:
        """The classifier adds the engagement columns, if there are any."""
        return "features_clf" if self.engagement else "features"

    def __post_init__(self) -> None:
        leaking = set(self.inputs + self.engagement) & set(self.withheld)
        if leaking:
            raise ValueError(f"withheld columns used as features: {', '.join(sorted(leaking))}")

    def groups(self) -> list[tuple[str, str]]:
        return (
            [(c, "continuous") for c in self.continuous]
            + [(c, "high_card") for c in self.high_card]
            + [(c, "low_card") for c in self.low_card]
            + [(c, "temporal") for c, _ in self.temporal]
            + [(c, "engagement") for c in self.engagement]
            + [(c, "withheld") for c in self.withheld]
        )


# Columns of the published cluster profiles, as (name, averaged column).
PROFILE = (
    ("avg_goal", "goal"),
    ("avg_pledged", "usd_pledged_real"),
    ("avg_backers", "backers"),
    ("avg_duration_days", "campaign_duration_days"),
    ("avg_funding_ratio", "funding_ratio"),
    ("success_rate", "label"),
)


@dataclass(frozen=True)
class SplitSpec:
    train_percent: int = 80
    folds: int = 3
    seed: int = 42
    salt: str = ""


@dataclass(frozen=True)
class ModelSpec:
    """Model parameters and tuning grids; the defaults are the published ones."""

    seed: int = 42
    reg_param: float = 0.01
    max_iter: int = 100
    forest_trees: tuple[int, ...] = (30, 40, 50)
    forest_depths: tuple[int, ...] = (2,)
    boost_rounds: tuple[int, ...] = (20, 50)
    boost_depths: tuple[int, ...] = (3, 5)
    max_bins: int = 256
    parallelism: int = 2


@dataclass(frozen=True)
class ClusterSpec:
    features: tuple[str, ...] = (
        "goal",
        "usd_pledged_real",
        "backers",
        "campaign_duration_days",
        "funding_ratio",
    )
    k: int = 4
    search: tuple[int, ...] = tuple(range(2, 11))
    seed: int = 42
    parallelism: int = 4
