"""Named parameter sets.

The pipeline exists in three generations that differ only in parameters and a few
rules; each is a frozen ``Profile``.  Operators take a profile (or the individual
keyword arguments) instead of branching on file names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Profile:
    name: str
    # weekly aggregate (H1)
    daily_preaggregate: bool = True          # sum by day x store x product first
    prep_lookback_months: int | None = 24    # month-floored history window
    total_quantity_rounding: str = "half_even"  # or "truncate"
    unit_price_clip: bool = False            # clip row unit price at 0
    wavg_fallback_mean: bool = False         # weight sum <= 0 -> plain mean (else null)
    week_from_calendar: bool = False         # week via calendar join instead of date arithmetic
    median_mode: str = "exact"               # "exact" (value buckets, no group in one task) or
                                             # "approx" (percentile_approx)
    median_accuracy: int = 10000
    # features (H2)
    rolling_min_periods: int | None = 2      # None -> window length
    price_min_periods: int = 2
    # model (H3)
    gbt_max_iter: int = 100
    gbt_max_depth: int = 2
    gbt_step_size: float = 0.1
    forecast_weeks: int = 12
    # breakdown (H4)
    breakdown_weeks: int = 8
    breakdown_month_floor: bool = True       # prod: month floor of as_of - 8 weeks
    breakdown_clip_negative: bool = False    # local clips, prod filters
    # replenishment
    sentinels: tuple = (9, 999)
    sales_lookback_days: int | None = 180    # None: all sales
    stock_month_floor_days: int | None = 30  # None: all stock rows
    lead_time_days: int = 2
    service_level: float = 0.9
    weighted_safety: bool = True
    weight_strategy: str = "exponential_decay"
    weight_decay_factor: float = 0.95
    recent_days_weight: float = 0.6
    w_base: float = 0.1
    w_slope: float = 0.1
    w_min: float = 0.0
    w_max: float = 0.20
    low_week_sales_cutoff: float | None = 4  # q7 < cutoff -> model weight 0
    need_rounding: str = "half_even"         # or "ceil"
    zero_need_without_sales: bool = True     # q28 == 0 -> need 0
    post_adjust: bool = True                 # prediction_df / safety_stock rewrite after need
    keep_order_up_to: bool = False
    drop_negative_predictions: bool = True
    null_safe_open_orders: bool = False
    open_order_depot: str = "entry"          # "entry" (first 4 chars) or "exit"
    integer_open_orders: bool = True
    only_positive_need: bool = False         # report rows with need > 0 only
    forecast_universe: bool = False          # pairs include forecast pairs; weights only where forecast > 0
    extra: dict = field(default_factory=dict)

    def with_(self, **kw) -> "Profile":
        return replace(self, **kw)


PROD = Profile(name="prod")

LOCAL = Profile(
    name="local",
    daily_preaggregate=False,
    prep_lookback_months=None,
    total_quantity_rounding="truncate",
    unit_price_clip=True,
    wavg_fallback_mean=True,
    week_from_calendar=True,
    rolling_min_periods=None,
    gbt_max_iter=300,
    gbt_max_depth=3,
    gbt_step_size=0.05,
    breakdown_month_floor=False,
    breakdown_clip_negative=True,
    sentinels=(999,),
    sales_lookback_days=None,
    stock_month_floor_days=None,
    open_order_depot="exit",
    only_positive_need=True,
    weighted_safety=False,
    w_base=0.5,
    w_slope=0.25,
    w_min=0.25,
    w_max=0.75,
    low_week_sales_cutoff=None,
    need_rounding="ceil",
    zero_need_without_sales=False,
    post_adjust=False,
    keep_order_up_to=True,
)

FUSED = LOCAL.with_(
    name="fused",
    sentinels=(9, 999),
    null_safe_open_orders=True,
    integer_open_orders=False,
    only_positive_need=False,
    daily_preaggregate=True,
    forecast_universe=True,
    drop_negative_predictions=False,
)

PROFILES = {p.name: p for p in (PROD, LOCAL, FUSED)}


def get_profile(p: "Profile | str | None") -> Profile:
    if p is None:
        return PROD
    if isinstance(p, Profile):
        return p
    return PROFILES[p]
