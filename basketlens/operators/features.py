"""Thirty behaviour flags per customer.

How it is computed:

1. Every purchase item gets one number whose bits say which *item conditions* hold for it (dairy in the
   last month, paid in cash, after 20:00, ...).
2. Items are reduced to one row per (customer, purchase) with a bitwise or, sums, minima and maxima. All
   of these combine before the shuffle, and all have fixed-width buffers, so it stays a hash aggregation
   and a basket travels as one narrow row.
3. Those rows are reduced to one per customer, again combining before the shuffle: "distinct purchases
   with property p" is now a plain conditional count.
4. Customers are joined to that result, one row per customer on both sides. No step sees all items of a
   customer, purchase, store or product in one task.

Breadth needs no distinct count of its own where the question is only "more than one store (or city)":
the least and the greatest of a 128-bit fingerprint differ. Where the number itself is asked for, step 2
has the grouping set (customer, value) beside (customer, purchase), in the same exchange. Counting
distinct ids directly would copy every item once per distinct expression, through the shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.config import FeatureConfig
from basketlens.operators.fact import enrich_items


def as_of(config: FeatureConfig) -> Column:
    return F.current_date() if config.as_of is None else F.lit(config.as_of)


def since(column: str, days: int, config: FeatureConfig) -> Column:
    """At or after midnight ``days`` before the as-of date."""
    return F.col(column) >= F.date_sub(as_of(config), days)


def item_conditions(config: FeatureConfig) -> dict[str, Column]:
    """What can be said about a single purchase item. The position in this table is the bit used."""
    roles = config.roles
    when = "purchase_datetime"
    hour = F.hour(when)
    counted = F.col("product_id").isNotNull()

    def is_category(name: str) -> Column:
        return F.col("category_name") == name

    return {
        "dairy_month": is_category(roles.dairy) & since(when, config.month_days, config),
        "fruit_fortnight": is_category(roles.fruit) & since(when, config.fortnight_days, config),
        "fruit_month": is_category(roles.fruit) & since(when, config.month_days, config),
        "vegetables_fortnight": is_category(roles.vegetables) & since(when, config.fortnight_days, config) & counted,
        "meat_week": is_category(roles.meat) & since(when, config.week_days, config),
        "meat_quarter": is_category(roles.meat) & since(when, config.quarter_days, config) & counted,
        "bakery": is_category(roles.bakery),
        "organic": F.col("is_organic"),
        "delivery": F.col("is_delivery"),
        "month": since(when, config.month_days, config),
        "night": hour > config.night_after_hour,
        "morning": hour < config.morning_before_hour,
        "midday": hour.between(*config.midday_hours),
        "weekend": F.dayofweek(when).isin(1, 7),
        "cash": F.col("payment_method") == "cash",
        "card": F.col("payment_method") == "card",
        "high_spend_week": (F.col("total_amount") >= config.spender_from) & since(when, config.week_days, config),
    }


class Profile:
    """Customer-level measures by name; remembers which of them the chosen flags read."""

    def __init__(self, config: FeatureConfig) -> None:
        self.config = config
        self.conditions: dict[str, None] = {}
        self.breadths: dict[str, None] = {}
        self.fingerprints: dict[str, None] = {}
        self.measures: set[str] = set()

    def _measure(self, name: str) -> Column:
        self.measures.add(name)
        return F.col(name)

    def any(self, condition: str) -> Column:
        """Some item of the customer meets the condition."""
        self.conditions[condition] = None
        self._measure(f"any_{condition}")
        return F.coalesce(F.col(f"any_{condition}"), F.lit(False))

    def purchases(self, condition: str | None = None) -> Column:
        """Distinct purchases, all of them or those with an item that meets the condition."""
        if condition is not None:
            self.conditions[condition] = None
        name = "purchases" if condition is None else f"purchases_{condition}"
        return F.coalesce(self._measure(name), F.lit(0))

    def share(self, condition: str) -> Column:
        return F.try_divide(self.purchases(condition), self.purchases())

    def distinct(self, column: str) -> Column:
        """Number of distinct values, exactly."""
        self.breadths[column] = None
        return F.coalesce(self._measure(f"distinct_{column}"), F.lit(0))

    def some(self, column: str) -> Column:
        """At least one value."""
        self.fingerprints[column] = None
        return F.coalesce(self._measure(f"some_{column}"), F.lit(False))

    def several(self, column: str) -> Column:
        """At least two distinct values."""
        self.fingerprints[column] = None
        return F.coalesce(self._measure(f"several_{column}"), F.lit(False))

    def at_least(self, column: str, number: int) -> Column:
        return self.several(column) if number == 2 else self.distinct(column) >= number

    @property
    def last_purchase(self) -> Column:
        return self._measure("last_purchase")

    @property
    def mean_amount(self) -> Column:
        return self._measure("mean_amount")

    @property
    def single_item_purchases(self) -> Column:
        return F.coalesce(self._measure("single_item_purchases"), F.lit(0))

    @property
    def mean_items(self) -> Column:
        return self._measure("mean_items")

    @property
    def registration_date(self) -> Column:
        return F.col("registration_date")

    @property
    def is_loyalty_member(self) -> Column:
        return F.col("is_loyalty_member")


@dataclass(frozen=True)
class Flag:
    name: str
    family: str
    rule: Callable[[Profile, FeatureConfig], Column]


def _inactive(m: Profile, c: FeatureConfig) -> Column:
    return ~since("last_purchase", c.fortnight_days, c) & (
        m.last_purchase >= F.date_sub(as_of(c), c.month_days)
    )


def _fruit_lover(m: Profile, c: FeatureConfig) -> Column:
    if c.fruit_counts == "purchase":
        return m.purchases("fruit_month") >= c.fruit_purchases
    # distinct category names among rows of a single category: one or none
    return m.any("fruit_month").cast("int") >= c.fruit_purchases


#: The names of the flags, in output order.
FLAGS: tuple[Flag, ...] = (
    Flag("bought_milk_last_30d", "recency", lambda m, c: m.any("dairy_month")),
    Flag("bought_fruits_last_14d", "recency", lambda m, c: m.any("fruit_fortnight")),
    Flag("not_bought_veggies_14d", "recency", lambda m, c: ~m.any("vegetables_fortnight")),
    Flag("recurrent_buyer", "lifecycle", lambda m, c: m.purchases("month") > c.recurrent_above),
    Flag("inactive_14_30", "lifecycle", _inactive),
    Flag("new_customer", "lifecycle", lambda m, c: m.registration_date >= F.date_sub(as_of(c), c.month_days)),
    Flag("delivery_user", "breadth", lambda m, c: m.any("delivery")),
    Flag("organic_preference", "breadth", lambda m, c: m.any("organic")),
    Flag("bulk_buyer", "basket", lambda m, c: m.mean_amount > c.bulk_above),
    Flag("low_cost_buyer", "basket", lambda m, c: m.mean_amount < c.low_below),
    Flag("buys_bakery", "breadth", lambda m, c: m.any("bakery")),
    Flag("loyal_customer", "lifecycle", lambda m, c: (m.purchases() >= c.loyal_purchases) & m.is_loyalty_member),
    Flag("multycity_buyer", "breadth", lambda m, c: m.at_least("city", c.cities)),
    Flag("bought_meat_last_week", "recency", lambda m, c: m.any("meat_week")),
    Flag("night_shopper", "daypart", lambda m, c: m.any("night")),
    Flag("morning_shopper", "daypart", lambda m, c: m.any("morning")),
    Flag("prefers_cash", "payment", lambda m, c: m.share("cash") >= c.payment_share),
    Flag("prefers_card", "payment", lambda m, c: m.share("card") >= c.payment_share),
    Flag("weekend_shopper", "weekend", lambda m, c: m.share("weekend") >= c.weekend_share),
    Flag(
        "weekday_shopper",
        "weekend",
        lambda m, c: F.try_divide(m.purchases() - m.purchases("weekend"), m.purchases()) >= c.weekend_share,
    ),
    Flag(
        "single_item_buyer",
        "basket",
        lambda m, c: F.try_divide(m.single_item_purchases, m.purchases()) >= c.single_item_share,
    ),
    Flag("varied_shopper", "breadth", lambda m, c: m.at_least("category_name", c.categories)),
    Flag("store_loyal", "breadth", lambda m, c: m.some("store_id") & ~m.several("store_id")),
    Flag("switching_loyal", "breadth", lambda m, c: m.several("store_id")),
    Flag("family_shopper", "basket", lambda m, c: m.mean_items >= c.family_items),
    Flag("early_bird", "daypart", lambda m, c: m.any("midday")),
    Flag("no_purchases", "lifecycle", lambda m, c: m.purchases() == 0),
    Flag("recent_high_spender", "recency", lambda m, c: m.any("high_spend_week")),
    Flag("fruit_lover", "recency", _fruit_lover),
    Flag("vegetarian_profile", "recency", lambda m, c: ~m.any("meat_quarter")),
)

FLAG_NAMES = tuple(flag.name for flag in FLAGS)
FAMILIES = tuple(dict.fromkeys(flag.family for flag in FLAGS))


Ask = Callable[[Profile], list[Column]]

# seeds of the two halves of a fingerprint: two different values would have to agree in both hashes
_SEEDS = (1, 2)


class _Aggregation:
    """The aggregates behind the measures that a set of output columns reads."""

    def __init__(self, config: FeatureConfig, ask: Ask) -> None:
        self.config = config
        self.profile = Profile(config)
        self.columns = ask(self.profile)
        self.bits = {name: 1 << i for i, name in enumerate(self.profile.conditions)}
        by_purchase = ("purchases", "mean_", "single_item")
        self.needs_purchases = any(m.startswith(by_purchase) for m in self.profile.measures)

    def holds(self, condition: str) -> str:
        return f"bits & {self.bits[condition]}L != 0"

    def prepared(self, items: DataFrame) -> DataFrame:
        """Items with their conditions and fingerprints as numbers."""
        conditions = item_conditions(self.config)
        items = items.withColumns({f"holds_{name}": conditions[name] for name in self.bits})
        added = {"bits": F.expr(" | ".join(["0L", *[f"if(holds_{name}, {bit}L, 0L)" for name, bit in self.bits.items()]]))}
        for column in self.profile.fingerprints:
            for seed in _SEEDS:
                added[f"{column}_{seed}"] = F.expr(f"if({column} IS NOT NULL, xxhash64({seed}, {column}), NULL)")
        return items.withColumns(added)

    def _item_aggregates(self) -> list[Column]:
        out = [F.bit_or("bits").alias("bits")]
        if "last_purchase" in self.profile.measures:
            out.append(F.max("purchase_datetime").alias("last_purchase"))
        for column in self.profile.fingerprints:
            for seed in _SEEDS:
                out.append(F.min(f"{column}_{seed}").alias(f"{column}_{seed}_least"))
                out.append(F.max(f"{column}_{seed}").alias(f"{column}_{seed}_greatest"))
        if self.needs_purchases:
            out.append(F.count("product_id").alias("items"))
            out.append(F.sum("total_amount").alias("amount"))
            out.append(F.count("total_amount").alias("amount_rows"))
        return out

    def by_grain(self, items: DataFrame) -> DataFrame:
        """Items to one row per customer and purchase (and per value of each column counted exactly)."""
        rows = self.prepared(items)
        keys = (["purchase_id"] if self.needs_purchases else []) + list(self.profile.breadths)
        if len(keys) <= 1:
            grain = F.lit(keys[0] if keys else "")
            return rows.groupBy("customer_id", *keys).agg(*self._item_aggregates()).withColumn("grain", grain)
        grain = F.coalesce(*[F.when(F.grouping(k) == 0, F.lit(k)) for k in keys]).alias("grain")
        # copies for the grains are made and combined in the map task: one exchange, and of the breadths only
        # what differs within a customer goes through it
        sets = [["customer_id", k] for k in keys]
        return rows.groupingSets(sets, "customer_id", *keys).agg(*self._item_aggregates(), grain)

    def by_customer(self, rows: DataFrame) -> DataFrame:
        at_purchase = "grain = 'purchase_id'"
        known = f"{at_purchase} AND purchase_id IS NOT NULL"
        sql = {
            "purchases": f"count_if({known})",
            "single_item_purchases": f"count_if({at_purchase} AND items = 1)",
            "mean_items": f"avg(if({at_purchase}, items, NULL))",
            "mean_amount": self._mean_amount(at_purchase),
            "last_purchase": "max(last_purchase)",
        }
        for c in self.bits:
            sql[f"any_{c}"] = f"bool_or({self.holds(c)})"
            sql[f"purchases_{c}"] = f"count_if({known} AND {self.holds(c)})"
        for column in self.profile.breadths:
            sql[f"distinct_{column}"] = f"count_if(grain = '{column}' AND {column} IS NOT NULL)"
        for column in self.profile.fingerprints:
            differ = [f"min({column}_{seed}_least) <> max({column}_{seed}_greatest)" for seed in _SEEDS]
            sql[f"some_{column}"] = f"min({column}_{_SEEDS[0]}_least) IS NOT NULL"
            sql[f"several_{column}"] = " OR ".join(differ)
        wanted = [F.expr(text).alias(name) for name, text in sql.items() if name in self.profile.measures]
        return rows.groupBy("customer_id").agg(*wanted or [F.count("*").alias("rows")])

    def _mean_amount(self, at_purchase: str) -> str:
        if self.config.basket_grain == "purchase":
            return f"avg(if({at_purchase}, try_divide(amount, amount_rows), NULL))"
        return f"try_divide(sum(if({at_purchase}, amount, NULL)), sum(if({at_purchase}, amount_rows, NULL)))"


def customer_profile(items: DataFrame, config: FeatureConfig, ask: Ask) -> DataFrame:
    """One row per customer with purchases: ``customer_id`` and the columns built from a profile.

    ``ask`` receives the profile and returns columns over its measures, for example
    ``lambda m: [m.purchases("cash").alias("cash_purchases")]``. Only what it reads is computed.
    """
    plan = _Aggregation(config, ask)
    return plan.by_customer(plan.by_grain(items)).select("customer_id", *plan.columns)


def _ask_flags(config: FeatureConfig, names: Iterable[str]) -> Ask:
    wanted = set(names)

    def ask(m: Profile) -> list[Column]:
        return [
            F.coalesce(flag.rule(m, config), F.lit(False)).alias(flag.name) for flag in FLAGS if flag.name in wanted
        ]

    return ask


def asked(config: FeatureConfig, names: Iterable[str]) -> tuple[set[str], list[Column]]:
    """The measures that the named flags read, and the flags over them."""
    profile = Profile(config)
    columns = _ask_flags(config, names)(profile)
    return profile.measures, columns


def fingerprint_names(column: str) -> list[str]:
    return [f"{column}_{seed}_{end}" for seed in _SEEDS for end in ("least", "greatest")]


def fingerprints_of(column: str) -> list[Column]:
    """Least and greatest fingerprints of a column's values."""
    found = []
    for seed in _SEEDS:
        value = F.expr(f"if({column} IS NOT NULL, xxhash64({seed}, {column}), NULL)")
        found += [F.min(value).alias(f"{column}_{seed}_least"), F.max(value).alias(f"{column}_{seed}_greatest")]
    return found


def merged_fingerprints(column: str) -> list[Column]:
    """The fingerprints of rows that hold those of `fingerprints_of`."""
    return [(F.min if name.endswith("_least") else F.max)(name).alias(name) for name in fingerprint_names(column)]


def several(column: str) -> tuple[Column, Column]:
    """Whether rows with fingerprints hold some value of a column, and at least two."""
    two = F.lit(False)
    for seed in _SEEDS:
        two = two | (F.min(f"{column}_{seed}_least") != F.max(f"{column}_{seed}_greatest"))
    return F.min(f"{column}_{_SEEDS[0]}_least").isNotNull(), two


def flags_from_items(
    customers: DataFrame,
    items: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    names: Iterable[str] | None = None,
) -> DataFrame:
    """``customer_id`` and the named flags (all thirty by default), one row per customer, no NULLs.

    ``items`` are enriched purchase items; only the aggregates the named flags need are computed.
    """
    plan = _Aggregation(config, _ask_flags(config, FLAG_NAMES if names is None else names))
    profile = plan.by_customer(plan.by_grain(items))
    who = customers.select(
        "customer_id", F.to_date("registration_date").alias("registration_date"), "is_loyalty_member"
    )
    return who.join(profile, "customer_id", "left").select("customer_id", *plan.columns)


def customer_features(
    customers: DataFrame,
    purchases: DataFrame,
    products: DataFrame,
    stores: DataFrame,
    address: DataFrame,
    config: FeatureConfig = FeatureConfig(),
    names: Iterable[str] | None = None,
    keep_cities: bool = False,
) -> DataFrame:
    """The flags from the five marts, each already reduced to its current rows."""
    items = enrich_items(purchases, products, stores, address, keep_cities)
    return flags_from_items(customers, items, config, names)


def family(name: str) -> tuple[str, ...]:
    """Flag names of one family."""
    found = tuple(f.name for f in FLAGS if f.family == name)
    if not found:
        raise KeyError(name)
    return found
