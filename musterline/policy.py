"""Domain constants, in one place and replaceable.

Operators take a ``Policy`` (or ``TradePolicy``) argument and hold no literals of
their own, so other tiers, thresholds or labels need no code change.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Tiers best to worst, thresholds, labels and points must equal
# the published rules for results to be comparable.
TIERS = ("Platinum", "High_Green", "Mid_Green", "Low_Green", "Yellow", "Red")
GRADED_TIERS = ("Platinum", "High_Green", "Mid_Green", "Low_Green")
SECTORS = (
    "Retail",
    "Construction",
    "Information Technology",
    "Healthcare",
    "Hospitality",
    "Manufacturing",
    "Financial Services",
    "Telecommunications",
)
SIZES = ("Micro", "Small", "Medium", "Large")
CONTRACT_TYPES = ("Permanent", "Fixed-term")
GENDERS = ("Male", "Female")
TIER_POINTS = {"Red": 40, "Yellow": 30, "Low_Green": 20, "Mid_Green": 10, "High_Green": 5}


@dataclass(frozen=True)
class Policy:
    """Rules of the workforce domain."""

    national: str = "Saudi"
    tiers: tuple[str, ...] = TIERS
    graded: tuple[str, ...] = GRADED_TIERS
    floor_tier: str = "Yellow"
    floor_pct: float = 6.0
    bottom_tier: str = "Red"
    sectors: tuple[str, ...] = SECTORS
    sizes: tuple[str, ...] = SIZES
    contract_types: tuple[str, ...] = CONTRACT_TYPES
    genders: tuple[str, ...] = GENDERS
    good_tiers: tuple[str, ...] = ("Platinum", "High_Green")
    middle_tiers: tuple[str, ...] = ("Mid_Green", "Low_Green")
    exposed_tiers: tuple[str, ...] = ("Yellow", "Red", "Low_Green")
    high_risk_tiers: tuple[str, ...] = ("Yellow", "Red")
    family: str = "Green"
    headcount_edges: tuple[int, ...] = (10, 50, 200, 500)
    headcount_labels: tuple[str, ...] = ("1-9", "10-49", "50-199", "200-499")
    headcount_rest: str = "500+"
    salary_edges: tuple[int, ...] = (5000, 10000, 20000)
    salary_labels: tuple[str, ...] = ("Entry Level", "Mid Level", "Senior Level")
    salary_rest: str = "Executive"
    soon_days: int = 30
    later_days: int = 90
    default_target: str = "Mid_Green"
    unknown_target_pct: float = 25.0
    tier_points: dict[str, int] = field(default_factory=lambda: dict(TIER_POINTS))
    critical_weight: int = 10
    critical_cap: int = 30
    alert_weight: int = 10
    alert_cap: int = 20
    gap_cap: int = 10
    many_critical: int = 2
    alert_ranking: tuple[str, ...] = ("High", "Medium")

    def threshold(self, tier: str) -> str:
        """Column of the rules table that holds the lower bound of ``tier``, in percent."""
        return f"{tier.lower()}_pct"

    @property
    def greens(self) -> tuple[str, ...]:
        return tuple(t for t in self.graded if self.family in t)

    @property
    def next_tier(self) -> dict[str, str]:
        """Tier to aim for next; tiers without a rule row of their own aim for the lowest graded one."""
        steps = {low: high for high, low in zip(self.graded, self.graded[1:])}
        return {t: steps.get(t, self.graded[-1]) for t in self.tiers if t != self.graded[0]}


@dataclass(frozen=True)
class TradePolicy:
    """Thresholds of the trade stream (percentages are in percent, not fractions)."""

    move_pct: float = 0.1
    high_move_pct: float = 0.5
    busy_trades: int = 2
    ratio_guard: float = 0.0001
    # Decimals kept in sums of prices and quantities.
    places: int = 8


@dataclass(frozen=True)
class QualityPolicy:
    """Bounds used by the anomaly detectors and the score grades."""

    salary_min: int = 1500
    salary_max: int = 200000
    odd_salary: tuple[int, int] = (2000, 100000)
    severe_salary: tuple[int, int] = (1500, 150000)
    rate_tolerance: float = 0.01
    size_bounds: tuple[tuple[str, str, int], ...] = (
        ("Large", "<", 100),
        ("Micro", ">", 15),
        ("Small", ">", 100),
    )
    few_below: int = 10
    grades: tuple[tuple[int, str], ...] = ((95, "Excellent"), (85, "Good"), (70, "Fair"))
    lowest_grade: str = "Poor"
