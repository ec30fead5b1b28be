"""What each column means to the operators, and the default thresholds."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Allowed:
    column: str
    values: tuple
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or f"{self.column.lower()}_unknown"


@dataclass(frozen=True)
class Range:
    column: str
    low: float
    high: float
    label: str | None = None

    @property
    def name(self) -> str:
        return self.label or f"{self.column.lower()}_out_of_range"


@dataclass(frozen=True)
class Flag:
    """A yes/no item of a transaction: ``column > above`` or ``column >= at_least``."""

    name: str
    column: str
    above: float | None = None
    at_least: float | None = None


@dataclass(frozen=True)
class Roles:
    batch: str | None = "batch_num"
    begin: str | None = None
    end: str | None = None
    time: str | None = None
    allowed: tuple[Allowed, ...] = ()
    ranges: tuple[Range, ...] = ()
    non_negative: tuple[str, ...] = ()
    zero_default: tuple[str, ...] = ()
    flags: tuple[Flag, ...] = ()
    high: tuple[tuple[str, str], ...] = ()  # (item name, column): value in the upper quartile
    long_item: str = "duration_ge_365"
    long_days: int = 365
    one_hot: tuple[str, ...] = ()
    target: str | None = None
    target_item: str = "claim_paid_pos"
    monitored_numeric: tuple[str, ...] = ()
    monitored_categorical: tuple[str, ...] = ()
    # model features
    identifier: str | None = None
    median_features: tuple[str, ...] = ()
    zero_features: tuple[str, ...] = ()
    categorical_features: tuple[str, ...] = ()

    @property
    def by(self) -> list[str]:
        return [self.batch] if self.batch else []


@dataclass(frozen=True)
class QualityLimits:
    max_missing_total: float = 0.30
    max_duplicate_ratio: float = 0.05
    max_bad_date_ratio: float = 0.01
    max_invalid_ratio: float = 0.03


@dataclass(frozen=True)
class Cleaning:
    drop_duplicates: bool = True
    drop_bad_date_order: bool = True
    drop_missing_time: bool = True
    out_of_range_to_null: bool = True
    negative_to_null: bool = True
    impute_numeric: str = "median"  # median, mean, none
    impute_categorical: str | None = "Unknown"


@dataclass(frozen=True)
class Mining:
    min_support: float = 0.03
    min_confidence: float = 0.4
    min_lift: float = 1.05
    top_k_rules: int = 5
    top_k_values: int = 5
    include_target: bool = False
    drop_constant: bool = True


@dataclass(frozen=True)
class RuleLimits:
    min_antecedent_count: int = 30
    min_confidence_abs: float = 0.30
    confidence_drop_ratio: float = 0.70
    support_drop_ratio: float = 0.50


@dataclass(frozen=True)
class DriftLimits:
    p_value: float = 0.01
    min_similarity: float = 0.8
    target_change: float = 0.1
    missing_side: float = 0.001
    missing_change: float = 0.05
    outlier_change: float = 0.5
    whisker: float = 1.5
    epsilon: float = 1e-8


@dataclass(frozen=True)
class Limits:
    quality: QualityLimits = field(default_factory=QualityLimits)
    cleaning: Cleaning = field(default_factory=Cleaning)
    mining: Mining = field(default_factory=Mining)
    rules: RuleLimits = field(default_factory=RuleLimits)
    drift: DriftLimits = field(default_factory=DriftLimits)


# The policy file layout, in file order.
POLICY_COLUMNS = (
    "SEX", "INSR_BEGIN", "INSR_END", "INSR_TYPE", "INSURED_VALUE", "PREMIUM", "OBJECT_ID", "PROD_YEAR",
    "SEATS_NUM", "CARRYING_CAPACITY", "TYPE_VEHICLE", "CCM_TON", "MAKE", "USAGE", "CLAIM_PAID",
)
POLICY_DATES = ("INSR_BEGIN", "INSR_END")
POLICY_NUMBERS = (
    "INSR_TYPE", "SEX", "INSURED_VALUE", "PREMIUM", "OBJECT_ID", "PROD_YEAR",
    "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON", "CLAIM_PAID",
)
POLICY_DROPPED = ("EFFECTIVE_YR",)

POLICY = Roles(
    begin="INSR_BEGIN",
    end="INSR_END",
    time="INSR_BEGIN",
    allowed=(Allowed("SEX", (0, 1, 2)), Allowed("INSR_TYPE", (1201, 1202, 1204))),
    ranges=(Range("PROD_YEAR", 1960, 2018), Range("SEATS_NUM", 1, 80, "seats_out_of_range")),
    non_negative=("INSURED_VALUE", "PREMIUM", "CLAIM_PAID"),
    zero_default=("CLAIM_PAID", "INSURED_VALUE", "CARRYING_CAPACITY", "CCM_TON", "SEATS_NUM"),
    flags=(Flag("premium_gt_0", "PREMIUM", above=0), Flag("seats_ge_5", "SEATS_NUM", at_least=5)),
    high=(("premium_high", "PREMIUM"), ("insured_value_high", "INSURED_VALUE")),
    one_hot=("INSR_TYPE", "TYPE_VEHICLE", "USAGE", "MAKE", "SEX"),
    target="CLAIM_PAID",
    monitored_numeric=("CLAIM_PAID", "INSURED_VALUE", "PREMIUM", "PROD_YEAR", "SEATS_NUM", "SEX", "INSR_TYPE"),
    identifier="OBJECT_ID",
    median_features=("PREMIUM", "PROD_YEAR", "SEATS_NUM", "CARRYING_CAPACITY", "CCM_TON"),
    zero_features=("INSURED_VALUE",),
    categorical_features=("SEX", "INSR_TYPE", "TYPE_VEHICLE", "MAKE", "USAGE"),
)
