"""Settings a deployment may change; everything else in the package is a function of these."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class CategoryRoles:
    """Category names (as they stand in the product mart) behind the diet-related flags."""

    # The category names of the retail chain, lower-case, without the leading emoji.
    dairy: str = "молочные продукты"
    fruit: str = "фрукты и ягоды"
    vegetables: str = "овощи и зелень"
    meat: str = "мясо, рыба, яйца и бобовые"
    bakery: str = "зерновые и хлебобулочные изделия"


@dataclass(frozen=True)
class FeatureConfig:
    """Windows, thresholds and reading choices of the thirty customer flags.

    ``as_of`` None means the current date; pass a date to make a run repeatable.
    """

    as_of: dt.date | None = None
    roles: CategoryRoles = field(default_factory=CategoryRoles)

    # Day windows and thresholds of the flags.
    week_days: int = 7
    fortnight_days: int = 14
    month_days: int = 30
    quarter_days: int = 90
    recurrent_above: int = 2
    loyal_purchases: int = 3
    cities: int = 2
    categories: int = 4
    payment_share: float = 0.7
    weekend_share: float = 0.6
    single_item_share: float = 0.5
    family_items: float = 4
    bulk_above: float = 1000
    low_below: float = 200
    spender_from: float = 2000
    fruit_purchases: int = 3
    night_after_hour: int = 20
    morning_before_hour: int = 10
    midday_hours: tuple[int, int] = (12, 14)

    # "purchase": fruit_lover counts distinct fruit purchases (the intended reading);
    # "category": it counts distinct category names among fruit rows, which never reaches three.
    fruit_counts: str = "purchase"
    # "item": mean basket amount over item rows (a purchase of n items weighs n);
    # "purchase": every purchase weighs the same.
    basket_grain: str = "item"

    def __post_init__(self) -> None:
        if self.fruit_counts not in ("purchase", "category"):
            raise ValueError(f"fruit_counts: {self.fruit_counts!r}")
        if self.basket_grain not in ("item", "purchase"):
            raise ValueError(f"basket_grain: {self.basket_grain!r}")


@dataclass(frozen=True)
class MaskingConfig:
    """How personal data is replaced.

    ``keyed``: sha2 of secret and value; equal values give equal tokens, so tokens can be joined.
    ``random``: md5 of value and an unsaved random salt; tokens cannot be joined or reproduced.
    The secret comes from the deployment, never from code.
    """

    mode: str = "keyed"
    secret: str | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("keyed", "random"):
            raise ValueError(f"masking mode: {self.mode!r}")
        if self.mode == "keyed" and not self.secret:
            raise ValueError("keyed masking needs a secret")
