"""Side unpivot (P1), root roll-up (A9 / A9b) and category roll-up (A10).

The side unpivot is a narrow row operation. A root report is combined by root
with the participant types side by side (``rollup_agg``), so its rows are
shuffled once; the fan-out to the types comes after that.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DecimalType, LongType

from bondmart import labels as L
from bondmart.functions.scalars import exact_sum
from bondmart.operators.joins import dedupe_latest, small

#: every participant type that the roll-up rules give
PARTICIPANT_TYPES = (L.JT_INSTITUTION, L.JT_PRODUCT, L.JT_MONEY_FUND)
CASH_TYPES = (L.JT_INSTITUTION, L.JT_PRODUCT)
SKETCH_LOG_K = 12  # a sketch of at most about 4 KB, 1.6 % standard error


def sides_unpivot(
    df: DataFrame,
    sides: Sequence[tuple[str, str, str]],
    member: str = "member",
    counter: str = "counter",
    side: str = "side",
    own: dict[str, Sequence[str]] | None = None,
) -> DataFrame:
    """One row per (deal, side). ``sides`` = [(label, member_col,
    counter_col), ...]; the two party columns are replaced by ``member`` /
    ``counter`` plus the ``side`` label. ``own``: further columns of the member,
    {name: its column on each side}. A side's values are picked after the rows are
    made, so what a report doesn't use is not carried to there."""
    of_side = {member: [a for _, a, _ in sides], counter: [b for _, _, b in sides], **(own or {})}
    taken = {c for cols in of_side.values() for c in cols}
    rest = [c for c in df.columns if c not in taken]

    def picked(cols: Sequence[str]) -> Column:
        out = F.when(F.lit(False), F.col(cols[0]))
        for (label, _, _), c in zip(sides, cols):
            out = out.when(F.col(side) == label, F.col(c))
        return out

    rows = df.withColumn(side, F.explode(F.array(*[F.lit(label) for label, _, _ in sides])))
    return rows.select(*rest, side, *[picked(cols).alias(n) for n, cols in of_side.items()])


REPO_SIDES = ((L.SIDE_REPO, "repo_unq_id", "rvrse_unq_id"), (L.SIDE_RVRSE, "rvrse_unq_id", "repo_unq_id"))
CASH_SIDES = ((L.SIDE_BUY, "buy_ip_id", "sell_ip_id"), (L.SIDE_SELL, "sell_ip_id", "buy_ip_id"))


def on_side(side_label: str, value, side: str = "side") -> Column:
    """Value on rows of one side, NULL elsewhere (for conditional aggregates)."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(F.col(side) == side_label, v)


def with_join_type_repo(
    df: DataFrame, roots: DataFrame, members: DataFrame, member: str = "member"
) -> DataFrame:
    """A9 classification for the repo job: adds ``root`` and ``join_type``.

    root = master of the member (one level) or the member itself;
    join_type = 机构 when root = member, 货币市场基金 when the member's full
    name contains that text, else 产品.
    """
    r = roots.select(F.col("unq_id").alias("_m"), F.col("root_unq_id").alias("_root"))
    n = members.select(F.col("unq_id").alias("_n"), F.col("full_nm").alias("_full"))
    x = df.join(small(r), F.col(member) == F.col("_m"), "left").join(
        small(n), F.col(member) == F.col("_n"), "left"
    )
    root = F.coalesce(F.col("_root"), F.col(member))
    jt = (
        F.when(root == F.col(member), F.lit(L.JT_INSTITUTION))
        .when(F.coalesce(F.col("_full"), F.lit("")).contains(L.JT_MONEY_FUND), F.lit(L.JT_MONEY_FUND))
        .otherwise(F.lit(L.JT_PRODUCT))
    )
    return x.withColumn("root", root).withColumn("join_type", jt).drop("_m", "_root", "_n", "_full")


def with_join_type_cash(
    df: DataFrame, roots: DataFrame, members: DataFrame, member: str = "member",
    by_unq: DataFrame | None = None,
) -> DataFrame:
    """A9b + J2b for the cash job: adds ``root`` (a member id) and
    ``join_type``: 机构 when the member has no master row, else 产品.

    member id -> unq id -> master unq id -> master's member id. A master
    that is not a member keeps the member's own id (the original job would
    fail there). ``by_unq``: unq_id -> ip_id, one row per unq_id (derived
    from ``members`` when not given).
    """
    ids = members.select(F.col("ip_id").alias("_ip"), F.col("unq_id").alias("_uq"))
    r = roots.select(F.col("unq_id").alias("_slv"), F.col("root_unq_id").alias("_mu"))
    if by_unq is None:
        by_unq = dedupe_latest(members.select("unq_id", "ip_id"), ["unq_id"], ["ip_id"])
    back = by_unq.select(F.col("unq_id").alias("_ru"), F.col("ip_id").alias("_rip"))
    x = (
        df.join(small(ids), F.col(member) == F.col("_ip"), "left")
        .join(small(r), F.col("_uq") == F.col("_slv"), "left")
        .join(small(back), F.col("_mu") == F.col("_ru"), "left")
    )
    has_master = F.col("_mu").isNotNull()
    root = F.when(has_master, F.coalesce(F.col("_rip"), F.col(member))).otherwise(F.col(member))
    jt = F.when(has_master, F.lit(L.JT_PRODUCT)).otherwise(F.lit(L.JT_INSTITUTION))
    return (
        x.withColumn("root", root).withColumn("join_type", jt)
        .drop("_ip", "_uq", "_slv", "_mu", "_ru", "_rip")
    )


def member_rollup(members: DataFrame, key: str, classify) -> DataFrame:
    """Per-member roll-up dimension (member -> root, join_type), from one of
    the ``with_join_type_*`` rules applied to the member list itself. It is
    bounded by the member dimension, so reports do one broadcast lookup
    instead of re-deriving the classification per row."""
    m = members.select(F.col(key).alias("member")).distinct()
    return classify(m).select("member", "root", "join_type")


def with_rollup(df: DataFrame, rollup: DataFrame, member: str = "member") -> DataFrame:
    """Attach (root, join_type) from a ``member_rollup`` dimension; a member
    missing from it is its own root of type 机构."""
    r = rollup.select(F.col("member").alias("_rm"), F.col("root").alias("_root"),
                      F.col("join_type").alias("_jt"))
    x = df.join(small(r), F.col(member) == F.col("_rm"), "left")
    return (x.withColumn("root", F.coalesce(F.col("_root"), F.col(member)))
            .withColumn("join_type", F.coalesce(F.col("_jt"), F.lit(L.JT_INSTITUTION)))
            .drop("_rm", "_root", "_jt"))


def _rooted(df: DataFrame, rollup: DataFrame, member: str) -> DataFrame:
    """``with_rollup``, if rows don't carry their root already."""
    return df if "root" in df.columns else with_rollup(df, rollup, member)


def explode_join_types(df: DataFrame, jt: str = "join_type") -> DataFrame:
    """Each row once under 全部 and once under its own participant type."""
    return df.withColumn(jt, F.explode(F.array(F.lit(L.JT_ALL), F.col(jt))))


def with_category(
    df: DataFrame, members: DataFrame, member: str, out: str,
    key: str = "unq_id", name: str = "ins_show_name", how: str = "inner",
    default: str | None = None,
) -> DataFrame:
    """Attach the display category of ``member``.

    ``how='inner'`` drops members without a category (repo job);
    ``how='left'`` with ``default`` keeps them under a label (cash job).
    """
    m = members.select(F.col(key).alias("_k"), F.col(name).alias(out))
    x = df.join(small(m), F.col(member) == F.col("_k"), how).drop("_k")
    if default is not None:
        x = x.withColumn(out, F.coalesce(F.col(out), F.lit(default)))
    return x


def _kinds(df: DataFrame, sums: dict[str, Column]) -> dict[str, DataType]:
    return {t.name: t.dataType for t in df.select(*[e.alias(n) for n, e in sums.items()]).schema} if sums else {}


def _addable(df: DataFrame, sums: dict[str, Column]) -> set[str]:
    """The sums whose total over all types is the exact sum of the types' sums:
    whole numbers, and decimals whose addition keeps the scale."""
    types = df.select(*[F.sum(e).alias(n) for n, e in sums.items()]).schema if sums else []
    return {t.name for t in types if isinstance(t.dataType, LongType)
            or isinstance(t.dataType, DecimalType) and t.dataType.scale <= 6}


def _apart(df: DataFrame, group: Sequence[str], sums: dict[str, Column], types: Sequence[str]) -> DataFrame:
    """groupBy(group) with each sum over the rows of each participant type
    (``<name>_1``, ...), which types have rows (``_types``, a bit each), and the
    sums over all rows (``<name>_0``) that can't be added up from these. One
    shuffle of rows combined map-side serves all types."""
    own = [F.col("join_type") == t for t in types]
    added, kinds = _addable(df, sums), _kinds(df, sums)
    bits = F.coalesce(*[F.when(t, F.lit(1 << i)) for i, t in enumerate(own)], F.lit(0))
    return df.groupBy(*group).agg(
        F.bit_or(bits).alias("_types"),
        *[exact_sum(e, kinds[n]).alias(f"{n}_0") for n, e in sums.items() if n not in added],
        *[exact_sum(F.when(t, e), kinds[n]).alias(f"{n}_{i}") for i, t in enumerate(own, 1) for n, e in sums.items()])


def _has(i: int) -> Column:
    """Whether the i-th type has rows."""
    return F.col("_types").bitwiseAND(1 << (i - 1)) > 0


def _of_type(apart: DataFrame, name: str, i: int, types: Sequence[str]) -> Column:
    """``<name>_<i>`` of ``_apart``; the total (0) from the types' sums if it isn't there."""
    if i or f"{name}_0" in apart.columns:
        return F.col(f"{name}_{i}")
    each = [F.col(f"{name}_{i}") for i in range(1, len(types) + 1)]
    some = F.coalesce(*each).isNotNull()
    total = functools.reduce(operator.add, [F.coalesce(c, F.lit(0)) for c in each])
    return F.when(some, total).cast(apart.schema[f"{name}_1"].dataType)


def _fanned_out(apart: DataFrame, keep: Sequence[str], names: Sequence[str], types: Sequence[str]) -> DataFrame:
    """A row of ``_apart`` once under 全部 and once under each type that has rows
    in it. Rows stay where they are."""
    held = F.array(F.lit(L.JT_ALL), *[F.when(_has(i), F.lit(t)) for i, t in enumerate(types, 1)])

    def own(n: str) -> Column:
        value = F.when(F.col("join_type") == L.JT_ALL, _of_type(apart, n, 0, types))
        for i, t in enumerate(types, 1):
            value = value.when(F.col("join_type") == t, F.col(f"{n}_{i}"))
        return value.alias(n)

    return apart.withColumn("join_type", F.explode(held)).where("join_type is not null").select(
        keep[0], "join_type", *keep[1:], *[own(n) for n in names])


def rollup_agg(df: DataFrame, rollup: DataFrame, keys: Sequence[str], sums: dict[str, Column],
               member: str = "member", types: Sequence[str] = PARTICIPANT_TYPES, tasks: int | None = None) -> DataFrame:
    """groupBy(root, join_type, keys) of ``df`` with sums, 全部 and the own type.
    Rows are combined by (root, keys) with the types' sums apart, so they are
    shuffled once and fan out to the types afterwards. With ``member`` among the
    keys they are combined by member, and its root is looked up at the end. Rows
    that carry their root (a stored grain) need no lookup. ``tasks``: first deal these by
    all keys to so many tasks; else rows that a lookup has dealt by one of the keys
    are combined where that has put them, in tasks made for the lookup."""
    keys = [k for k in keys if k not in ("root", "join_type")]
    has_root = "root" in df.columns
    if has_root and tasks:
        values = {f"_sum_{i}": e for i, e in enumerate(sums.values())}
        df = _placed(df.select("root", "join_type", *keys, *[e.alias(v) for v, e in values.items()]), [tasks, "root", *keys], types)
        sums = {n: F.col(v) for n, v in zip(sums, values)}
    if member in keys:
        kinds = _kinds(df, sums)
        first = df.groupBy(*(["root", "join_type"] if has_root else []), *keys).agg(
            *[exact_sum(e, kinds[n]).alias(n) for n, e in sums.items()])
        return explode_join_types(first if has_root else with_rollup(first, rollup, member))
    rows = _rooted(df, rollup, member)
    return _fanned_out(_apart(rows, ["root", *keys], sums, types), ["root", *keys], list(sums), types)


def _one_row_a_set(rows: DataFrame, keys: Sequence[str], values: Sequence[str], sums: Sequence[str], sets: int) -> DataFrame:
    """Rows with root, join_type, keys, values and ``_item_0``, ... as a row per set: its
    number (``_set``, if there are several) and ``item``; ``sums`` stand on the rows of the first set."""
    if sets == 1:
        return rows.withColumnRenamed("_item_0", "item")
    held = F.array(*[F.struct(F.lit(i).cast("byte").alias("set"), F.col(f"_item_{i}").alias("item")) for i in range(sets)])
    return rows.withColumn("_s", F.explode(held)).select(
        "root", "join_type", *keys, F.col("_s.set").alias("_set"), "_s.item",
        *[F.when(F.col("_s.set") == 0, F.col(n)).alias(n) if n in sums else n for n in values])


def _placed(rows: DataFrame, place: Sequence[str | Column | int], types: Sequence[str]) -> DataFrame:
    """``rows`` by ``place``; their type is shuffled as a number."""
    code, label = F.when(F.lit(False), F.lit(0)), F.when(F.lit(False), F.lit(""))
    for i, t in enumerate(types):
        code, label = code.when(F.col("join_type") == t, F.lit(i)), label.when(F.col("_type") == i, F.lit(t))
    return rows.withColumn("_type", code.cast("byte")).drop("join_type").repartition(*place).withColumn("join_type", label).drop("_type")


def items_apart(df: DataFrame, rollup: DataFrame, keys: Sequence[str], sums: dict[str, Column],
                sets: dict[str, Column], member: str = "member", count: Column | None = None,
                types: Sequence[str] = PARTICIPANT_TYPES, counted: bool = True, named: bool = True,
                place: Sequence[str | Column | int] = ()) -> DataFrame:
    """The distinct rows of ``rollup_items`` by (root, keys, set_name, item), before
    the fan-out: the types' numbers and sums side by side (``_apart``).
    ``counted``: with ``n_rows``, which only readers of the item rows need; not ``named``:
    the sets by number (``_set``), for readers that shuffle the rows once more.

    ``place``: columns of ``keys`` and root to bring the rows together by (after a number of
    tasks, if given). Rows that carry their root are shuffled by these alone, before
    they become a row per set, and made distinct where they are: they carry it
    where members are too many to broadcast, and then hardly two rows of a root
    and day share an item. Others are made distinct first, combined map-side."""
    numbers = {"n_rows": F.lit(1).cast("long") if count is None else count} if counted else {}
    values = {**numbers, **sums}
    carried = [c for c in ("root", "join_type") if c in df.columns]
    rows = df.select(*(carried or [member]), *keys, *[e.alias(n) for n, e in values.items()],
                     *[e.cast("string").alias(f"_item_{i}") for i, e in enumerate(sets.values())])
    rows = _placed(rows, place, types) if place and carried else _rooted(rows, rollup, member)
    rows = _one_row_a_set(rows, keys, list(values), list(sums), len(sets))
    number = ["_set"] if len(sets) > 1 else []  # the name of the only set is the same on all rows
    apart = _apart(rows, ["root", *keys, *number, "item"], {n: F.col(n) for n in values}, types)
    rest = [c for c in apart.columns if c not in ("root", "_set", *keys)]
    at = F.col("_set") if number else F.lit(0).cast("byte")
    apart = apart.select("root", *keys, at.alias("_set"), *rest)
    if place and not carried:
        apart = apart.repartition(*place)
    name = F.element_at(F.array(*map(F.lit, sets)), F.col("_set") + F.lit(1)).alias("set_name")
    return apart.select("root", *keys, name, *rest) if named else apart


def rollup_items(df: DataFrame, rollup: DataFrame, keys: Sequence[str], sums: dict[str, Column],
                 sets: dict[str, Column], member: str = "member", count: Column | None = None,
                 types: Sequence[str] = PARTICIPANT_TYPES, place: Sequence[str | Column | int] = ()) -> DataFrame:
    """A4 by root without arrays: a row per (root, join_type, keys, set_name,
    item) with the number of rows that hold the item (``n_rows``; ``count``: how
    many each row stands for) and their sums.

    Distinct rows are made once, by root, with the types apart: partial and final
    aggregates, so no row grows with the size of a set and a hot root is spread
    over its items. Each row of ``df`` counts once per
    set; ``sums`` stand on the rows of the first set alone. A null item is a
    row (with its sums) that belongs to no set. ``place``: see ``items_apart``, for
    a reader that groups by these columns and the type.
    """
    keys = [k for k in keys if k not in ("root", "join_type")]
    apart = items_apart(df, rollup, keys, sums, sets, member, count, types, place=place)
    return _fanned_out(apart, ["root", *keys, "set_name", "item"],
                       ["n_rows", *sums], types)


def rollup_sizes(df: DataFrame, rollup: DataFrame, keys: Sequence[str], sums: dict[str, Column],
                 sets: dict[str, Column], member: str = "member",
                 types: Sequence[str] = PARTICIPANT_TYPES, tasks: int | None = None) -> DataFrame:
    """``set_sizes`` of ``rollup_items``, counted with the types apart: the fan-out
    sees one row per (root, keys)."""
    keys = [k for k in keys if k not in ("root", "join_type")]
    place = [*([tasks] if tasks else []), "root", *keys] if "root" in df.columns else []  # else partial counts are shuffled
    apart = items_apart(df, rollup, keys, sums, sets, member, None, types, counted=False, named=False, place=place)
    every = range(len(types) + 1)
    sizes = apart.groupBy("root", *keys).agg(
        F.bit_or("_types").alias("_types"), *_summed(apart, sums),
        *[F.count(F.when((F.col("_set") == at) & (_has(i) if i else F.lit(True)), F.col("item"))).alias(f"{n}_size_{i}")
          for i in every for at, n in enumerate(sets)])
    return _fanned_out(sizes, ["root", *keys], [*sums, *[f"{n}_size" for n in sets]], types)


def _summed(apart: DataFrame, sums: Sequence[str]) -> list[Column]:
    """The sums of ``_apart``, to be combined over more of its rows."""
    return [F.sum(c).alias(c) for c in apart.columns if c.rpartition("_")[0] in sums and c.rpartition("_")[2].isdigit()]


def rollup_strings(df: DataFrame, rollup: DataFrame, keys: Sequence[str], sums: dict[str, Column],
                   sets: dict[str, Column], text: Callable[[Column], Column], member: str = "member",
                   types: Sequence[str] = PARTICIPANT_TYPES, tasks: int | None = None) -> DataFrame:
    """One row per (root, join_type, keys) with sums, each set as ``text`` of its
    items and its ``<set>_size``. The distinct items of (root, keys) are brought
    together before the fan-out and collected with the types apart, so an item is
    handled once and where one type alone has rows its string is 全部's as well.
    The one aggregate whose row grows with a set."""
    keys = [k for k in keys if k not in ("root", "join_type")]
    place = [*([tasks] if tasks else []), "root", *keys]
    apart = items_apart(df, rollup, keys, sums, sets, member, None, types, counted=False, named=False, place=place)
    own = range(1, len(types) + 1)
    g = apart.groupBy("root", *keys).agg(
        F.bit_or("_types").alias("_types"), *_summed(apart, sums),
        *[F.collect_list(F.when((F.col("_set") == at) & _has(i), F.col("item"))).alias(f"_{n}_{i}")
          for i in own for at, n in enumerate(sets)])
    rest = [c for c in g.columns if c not in {f"_{n}_{i}" for i in own for n in sets}]
    strings = g.select(*rest, *[c for i in own for n in sets for c in (
        text(F.col(f"_{n}_{i}")).alias(f"{n}_{i}"), F.size(f"_{n}_{i}").cast("long").alias(f"{n}_size_{i}"))], *[
        # types share items: those of all types are made distinct again
        F.when(F.bit_count("_types") > 1, F.array_distinct(F.concat(*[F.col(f"_{n}_{i}") for i in own]))).alias(f"_{n}") for n in sets])

    def whole(n: str, of_items: Callable[[Column], Column], out: str) -> Column:
        one = functools.reduce(lambda w, i: w.when(_has(i), F.col(f"{out}_{i}")), own, F.when(F.bit_count("_types") > 1, of_items(F.col(f"_{n}"))))
        return one.alias(f"{out}_0")

    strings = strings.select(*[c for c in strings.columns if c not in {f"_{n}" for n in sets}], *[
        c for n in sets for c in (whole(n, text, n), whole(n, lambda items: F.size(items).cast("long"), f"{n}_size"))])
    return _fanned_out(strings, ["root", *keys], [*sums, *[c for n in sets for c in (n, f"{n}_size")]], types)


def set_sizes(items: DataFrame, keys: Sequence[str], sums: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """One row per ``keys`` of item rows: sums and ``<set>_size``. Items are
    distinct rows already, so a size is a count."""
    return items.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums], *[
        F.count(F.when(F.col("set_name") == n, F.col("item"))).alias(f"{n}_size") for n in sets])


def set_arrays(items: DataFrame, keys: Sequence[str], sums: Sequence[str], sets: Sequence[str]) -> DataFrame:
    """``set_sizes`` and each set as an array, for readers that ask for whole
    sets: the one aggregate whose row grows with a set."""
    return items.groupBy(*keys).agg(
        *[F.sum(n).alias(n) for n in sums],
        *[F.count(F.when(F.col("set_name") == n, F.col("item"))).alias(f"{n}_size") for n in sets],
        *[F.collect_list(F.when(F.col("set_name") == n, F.col("item"))).alias(n) for n in sets])


def set_sketches(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A mergeable sketch (HyperLogLog) of each set of item rows."""
    return items.where("item is not null").groupBy(*keys, "set_name").agg(F.hll_sketch_agg("item", SKETCH_LOG_K).alias("sketch"))


def merged_sizes(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Estimated distinct items of unions of sketches (of days, roots, ...)."""
    return sketches.groupBy(*keys, "set_name").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))


def period_sizes(items: DataFrame, keys: Sequence[str], day: str) -> DataFrame:
    """Distinct items by ``keys`` of item rows by day: exact (``n_items``: an item
    counts on its first day), and as the merged sketches of the days estimate
    it. One pass; rows that lie together by keys stay where they are."""
    first = F.row_number().over(Window.partitionBy(*keys, "item").orderBy(day)) == 1
    rows = items.select(*keys, day, "item", F.when(first & F.col("item").isNotNull(), 1).alias("_first"))
    days = rows.groupBy(*keys, day).agg(
        F.count("_first").alias("n_items"), F.hll_sketch_agg("item", SKETCH_LOG_K).alias("sketch"))
    return days.groupBy(*keys).agg(
        F.sum("n_items").alias("n_items"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
