"""Domain constants of the loan-risk analyses.

Everything in this module is data, not logic: the operators take these as
defaults and accept any other configuration.
"""

from __future__ import annotations

from dataclasses import dataclass

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the published analysis for identical results)
# ---------------------------------------------------------------------------

# Loan outcome: status strings, exact and case-sensitive.
GOOD_STATUSES = ("Fully Paid",)
BAD_STATUSES = (
    "Charged Off",
    "Default",
    "Late (31-120 days)",
    "Does not meet the credit policy. Status:Charged Off",
)

# Month abbreviations used by the `Mon-YYYY` issue date.
MONTH_ABBREVIATIONS = (
    "Jan", "Feb", "Mar", "Apr", "May", "Jun",
    "Jul", "Aug", "Sep", "Oct", "Nov", "Dec",
)

UNKNOWN = "Unknown"

# Bin schemes: (exclusive upper bound, label); the last bound is a sentinel.
INTEREST_BINS = ((8, "<8%"), (12, "8-12%"), (16, "12-16%"), (20, "16-20%"), (24, "20-24%"), (10**9, ">=24%"))
INCOME_BINS = ((40000, "<40k"), (60000, "40-60k"), (80000, "60-80k"), (120000, "80-120k"), (10**12, ">=120k"))
DTI_BINS = ((10, "<10"), (20, "10-20"), (30, "20-30"), (40, "30-40"), (10**9, ">=40"))
FICO_BINS = ((660, "<660"), (700, "660-700"), (740, "700-740"), (10**9, ">=740"))
LOAN_AMOUNT_BINS = ((5000, "<5k"), (10000, "5-10k"), (20000, "10-20k"), (30000, "20-30k"), (10**12, ">=30k"))

# Explicit display order of the employment-length categories.
EMP_LENGTH_ORDER = (
    "< 1 year", "1 year", "2 years", "3 years", "4 years", "5 years",
    "6 years", "7 years", "8 years", "9 years", "10+ years", "Unknown",
)

# Grades counted in the per-state grade shares.
GRADES = ("A", "B", "C", "D", "E", "F", "G")

# State economics: long-file attribute -> output column.
UNEMPLOYMENT_ATTRIBUTES = (
    ("Unemployment_rate_2023", "ers_unemployment_rate_2023"),
    ("Median_Household_Income_2022", "ers_median_household_income_2022"),
)
OPTIONAL_UNEMPLOYMENT_ATTRIBUTES = (
    ("Median_Household_Income_2023", "ers_median_household_income_2023"),
)
POVERTY_ATTRIBUTES = (("PCTPOVALL_2023", "ers_poverty_rate_2023"),)

# State-control correlation matrix: targets x features, target-major.
CONTROL_TARGETS = (
    "default_rate",
    "default_residual_after_avg_interest",
    "default_residual_after_avg_fico",
)
CONTROL_FEATURES = (
    "ers_poverty_rate_2023",
    "ers_median_household_income_2022",
    "ers_unemployment_rate_2023",
    "avg_interest_rate",
    "avg_fico",
    "share_grade_A",
    "share_grade_G",
)

# Correlation tables: features correlated with the default rate.
ANNUAL_MACRO_FEATURES = ("avg_fed_funds_rate", "avg_unemployment_rate", "cpi_inflation_rate")
QUARTERLY_MACRO_FEATURES = ("avg_fed_funds_rate", "avg_unemployment_rate", "quarterly_cpi_inflation_rate")
STATE_FEATURES = ("ers_unemployment_rate_2023", "ers_median_household_income_2022", "ers_poverty_rate_2023")

# Minimum group size used by the published state / purpose / segment tables.
DEFAULT_MIN_LOANS = 1000

# Chart constants: span floor of min-max scaling, label width, top-k sizes.
SCALE_SPAN_FLOOR = 0.001
SEGMENT_LABEL_WIDTH = 24
BAR_LABEL_WIDTH = 12
TICK_TARGET = 8
TOP_STATES = 12
TOP_PURPOSES = 10
TOP_SEGMENTS = 12
TOP_SCATTER_LABELS = 5
MISSING_TOP = 40

# ---------------------------------------------------------------------------


@dataclass(frozen=True)
class BinSpec:
    """Ordered upper-exclusive bins plus the label for missing values."""

    bins: tuple[tuple[float, str], ...]
    unknown: str = UNKNOWN

    @property
    def order(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.bins) + (self.unknown,)


INTEREST = BinSpec(INTEREST_BINS)
INCOME = BinSpec(INCOME_BINS)
DTI = BinSpec(DTI_BINS)
FICO = BinSpec(FICO_BINS)
LOAN_AMOUNT = BinSpec(LOAN_AMOUNT_BINS)
