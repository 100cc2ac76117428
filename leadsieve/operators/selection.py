"""Per-key selection, positions and sets."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from leadsieve.session import stored

#: Order values of these types fit into hash aggregates; nulls come below all of them.
_WHOLE = ("tinyint", "smallint", "int", "bigint")
LOWEST = -(1 << 63)
_BELOW, _STEP = Decimal(-99 * 10 ** 17), Decimal(10 ** 19)
#: A filter sent to all tasks holds so many bytes at most; an index of positions samples so many keys.
FILTER_BYTES = 64 << 20
INDEX_SAMPLE = 20_000


def order_value(df: DataFrame, seq: str) -> Column:
    """What orders records by `seq`, null first. A whole number stays one, which hash aggregates can hold."""
    if df.schema[seq].dataType.simpleString() in _WHOLE:
        return F.coalesce(F.col(seq).cast("bigint"), F.lit(LOWEST))
    return F.struct(F.col(seq).isNotNull(), F.col(seq))


def latest_by(df: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """The last record of each key; rows with a blank key are dropped, null order values come first.

    One pass over `df`, for tables that a plan computes: an aggregate of whole rows, so a key with many
    records is reduced before the shuffle. For stored logs see `latest_stored`.
    """
    return _one_by(df, key, F.max_by(F.struct(*df.columns), order_value(df, seq)))


def first_by(df: DataFrame, key: str, seq: str) -> DataFrame:
    """The first record of each key; rows with a blank key are dropped, null order values come last."""
    return _one_by(df, key, F.min_by(F.struct(*df.columns), F.struct(F.col(seq).isNull(), F.col(seq))))


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.coalesce(F.col(key), F.lit("")) != "") \
        if df.schema[key].dataType.simpleString() == "string" else df.where(F.col(key).isNotNull())


def _one_by(df: DataFrame, key: str, pick: Column) -> DataFrame:
    return _keyed(df, key).groupBy(F.col(key).alias("_key")).agg(pick.alias("_row")).select("_row.*")


def latest_stored(log: DataFrame, key: str, seq: str = "seq") -> DataFrame:
    """`latest_by` in two phases, for stored logs, which are read twice.

    A hash aggregate finds, for each key, the largest number made of order value and row locator (a
    hash of the row, so that it is the same whenever the log is read); a semi-join then fetches these
    rows, so whole rows are neither sorted nor shuffled unless they stay. Of records with one order
    value any one stays, the same one every time. Order values that are no whole numbers, and
    logs with map columns, take the one-pass way.
    """
    kinds = [f.dataType.simpleString() for f in log.schema.fields]
    if log.schema[seq].dataType.simpleString() not in _WHOLE or any("map<" in k for k in kinds):
        return latest_by(log, key, seq)
    order = F.coalesce(F.col(seq).cast("decimal(20,0)"), F.lit(_BELOW).cast("decimal(20,0)"))
    locator = F.xxhash64(*[F.col(f"`{c}`") for c in log.columns]).bitwiseAND(F.lit((1 << 63) - 1))
    placed = _keyed(log, key).withColumn(
        "_at", (order * F.lit(_STEP).cast("decimal(20,0)") + locator.cast("decimal(20,0)")).cast("decimal(38,0)"))
    newest = placed.groupBy(key).agg(F.max("_at").alias("_at"))
    # What is left are the rows themselves and exact repeats of them.
    return placed.join(newest, [key, "_at"], "left_semi").drop("_at").distinct()


def with_maybe(wide: DataFrame, keys: DataFrame, on: list[str], name: str, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """A wide table with a column that is false only for rows whose key columns, none null, are not in `keys`.

    `keys` is a stored narrow table. A Bloom filter of the keys (16 bits each) tells nearly all other rows where
    they are scanned. It is sent to all tasks, so it is only made where it holds `filter_bytes` at
    most; beyond that the column is true.
    """
    bits = 1 << max(15, (16 * max(1, keys.count()) - 1).bit_length())
    if bits // 8 > filter_bytes:
        return wide.withColumn(name, F.lit(True))
    at = F.xxhash64(*on).bitwiseAND(F.lit(bits - 1))
    spots = keys.select(at.alias("_h")).selectExpr(
        "_h >> 15 AS _leaf", "(_h >> 6) & 511 AS _word", "shiftleft(1L, CAST(_h & 63 AS INT)) AS _bit")
    words = spots.groupBy("_leaf", "_word").agg(F.bit_or("_bit").alias("_bits"))
    leaves = words.groupBy("_leaf").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_map")) \
        .selectExpr("_leaf", "transform(sequence(0L, 511L), w -> coalesce(_map[w], 0L)) AS _words")  # 4 KiB each
    hit = F.expr("coalesce((element_at(_words, CAST((_h >> 6) & 511 AS INT) + 1) & shiftleft(1L, CAST(_h & 63 AS INT))) <> 0, false)")
    return wide.withColumn("_h", at).join(F.broadcast(leaves), F.expr("_leaf = _h >> 15"), "left") \
        .withColumn(name, hit).drop("_h", "_leaf", "_words")


def may_hold(wide: DataFrame, keys: DataFrame, on: list[str], filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of a wide table whose key is in `keys`, and a few others; see `with_maybe`.

    So the bytes that a join shuffles after it follow the rows that match.
    """
    return with_maybe(wide, keys, on, "_maybe", filter_bytes).where("_maybe").drop("_maybe")


def fetch_rows(wide: DataFrame, keys: DataFrame, on: list[str], filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """Exactly the rows of a wide table whose key columns are in `keys`; see `may_hold`."""
    return may_hold(wide, keys, on, filter_bytes).join(keys.select(*on), on, "left_semi")


def spread_join(wide: DataFrame, owners: DataFrame, key: str, by: str, rows: str | None = None) -> DataFrame:
    """Join a wide table to owners, one row per key, however many rows one key has.

    Keys with more rows than a task's even share are found by a narrow count, or from the owners' column `rows`
    that tells how many there are; fewer keys than tasks can be so large. Their rows are dealt over
    salts by a hash of `by`, and their owner is repeated for each salt.
    """
    tasks = int(wide.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = owners.select(key, F.col(rows).alias("_n")) if rows else wide.groupBy(key).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.where(F.col("_n") * tasks > total).collect() if total else []

    def literal(value) -> Column:
        return F.struct(*[F.lit(v).alias(c) for c, v in value.asDict().items()]) if isinstance(value, Row) else F.lit(value)

    salts = F.lit(1)
    if hot:
        pairs = [c for r in hot for c in (literal(bytes(r[0]) if isinstance(r[0], bytearray) else r[0]), F.lit(-(-2 * tasks * r[1] // total)))]
        salts = F.coalesce(F.try_element_at(F.create_map(*pairs), F.col(key)), F.lit(1)).cast("int")
    dealt = wide.withColumn("_salt", F.pmod(F.xxhash64(by), salts).cast("int"))
    repeated = (owners.drop(rows) if rows else owners).withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return dealt.join(repeated, [key, "_salt"]).drop("_salt")


@dataclass
class KeyIndex:
    """Order statistics of a table's keys: sorted borders, and how many keys lie before each range."""

    order: tuple[str, ...]
    kinds: list[str]
    borders: list[tuple]
    before: list[int]
    total: int

    def range_of(self) -> Column:
        """The range of a row, from 0: how many borders its key reaches, by binary search."""
        if not self.borders:
            return F.lit(0)
        border = F.array(*[F.struct(*[F.lit(v).cast(t).alias(c) for c, t, v in zip(self.order, self.kinds, b, strict=True)])
                           for b in self.borders])
        key = F.struct(*[F.col(c).alias(c) for c in self.order])
        steps = [1 << k for k in reversed(range(len(self.borders).bit_length()))]

        def step(at: Column, size: Column) -> Column:
            there = at + size
            return F.when((there <= len(self.borders)) & (F.get(border, there - 1) <= key), there).otherwise(at)

        return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step)


def key_index(df: DataFrame, *order: str, ranges: int | None = None) -> KeyIndex:
    """Index a table by unique columns: borders from a bounded sample of keys, then one count per range.

    The sample is chosen by a hash of the key, so equal tables have equal indexes. Only it and the
    counts reach the driver; both passes read the order columns alone.
    """
    keys = df.select(*order)
    ranges = ranges or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sample = [tuple(r) for r in keys.orderBy(F.xxhash64(*order), *order).limit(INDEX_SAMPLE).orderBy(*order).collect()]
    borders = [sample[k * len(sample) // ranges] for k in range(1, ranges) if len(sample) >= ranges] if ranges > 1 else []
    index = KeyIndex(order, [f.dataType.simpleString() for f in keys.schema.fields], borders, [], 0)
    counts = {r["at"]: r["n"] for r in keys.groupBy(index.range_of().alias("at")).agg(F.count("*").alias("n")).collect()}
    for k in range(len(borders) + 1):
        index.before.append(index.total)
        index.total += counts.get(k, 0)
    return index


def with_row_index(df: DataFrame, *order: str, name: str = "row_idx",
                   total: str | None = None, index: KeyIndex | None = None) -> DataFrame:
    """Number the rows 0, 1, 2, ... in the order of unique columns.

    An index of the keys tells how many rows lie before each range; rows are numbered within their
    range, so they shuffle once and no copy of the table is kept. The ranges are part of the plan, so
    a task that runs again gives the same numbers. `total` adds the row count.
    """
    index = index or key_index(df, *order)
    place = Window.partitionBy("_range").orderBy(*order)
    before = F.get(F.array(*[F.lit(n).cast("bigint") for n in index.before]), F.col("_range"))
    extra = [F.lit(index.total).cast("bigint").alias(total)] if total else []
    return df.withColumn("_range", index.range_of()).select(
        (F.row_number().over(place) - 1 + before).alias(name), *[f"`{c}`" for c in df.columns], *extra)


def chunk(df: DataFrame, *order: str, size: int) -> DataFrame:
    """Consecutive batches of `size` rows: batch number and place in the batch."""
    return with_row_index(df, *order, name="_pos").select(
        F.floor(F.col("_pos") / size).alias("batch"), (F.col("_pos") % size).alias("place"),
        *df.columns)


def cap_share(todo: DataFrame, *order: str, share: float, of: DataFrame | None = None,
              cap: int | None = None) -> DataFrame:
    """The first rows to do: `cap` if given, else a share of all rows `of`, at least one.

    Order columns are unique and not null; only they are numbered.
    """
    if cap:
        return todo.orderBy(*order).limit(cap)
    limit = max(1, int(share * (todo if of is None else of).count()))
    first = with_row_index(todo.select(*order), *order, name="_pos").where(F.col("_pos") < limit)
    return todo.join(first.drop("_pos"), list(order), "left_semi")


def top_k(df: DataFrame, col: str, k: int) -> DataFrame:
    """The k most frequent values; ties go to the smaller value."""
    return df.groupBy(col).agg(F.count("*").alias("n")).orderBy(F.desc("n"), col).limit(k)


def frequent(df: DataFrame, col: str, k: int, tracked: int = 10_000) -> DataFrame:
    """`top_k` of a stored table with very many different values, most of which are never shuffled.

    A frequent-items sketch, merged from those of all tasks, proposes values and bounds what any other can reach; the
    proposed ones are counted exactly in a second pass. If the k-th of them is above that bound, no other
    value belongs to the first k; if it is not, all values are counted.
    """
    sketch = stored(df.agg(F.count("*").alias("rows"), F.expr(
        f"transform(approx_top_k(`{col}`, {tracked}, {tracked}), t -> t.item)").alias("items")), "sketch")
    # A sketch of 2^m places is off by 3.5 / 2^m of all rows at most, so what occurs twice as often is proposed.
    places = 1 << (-(-tracked * 4 // 3) - 1).bit_length()
    bound = 7 * sketch.first()["rows"] / places
    proposed = stored(sketch.select(F.explode("items").alias("_item")), "proposed")  # its size is known to Spark
    counted = top_k(df.join(proposed, F.col(col).eqNullSafe(F.col("_item")), "left_semi"), col, k)
    best = stored(counted, "frequent")
    least = best.agg(F.count("*").alias("found"), F.min("n").alias("n")).first()
    return best.orderBy(F.desc("n"), col) if least["found"] == k and least["n"] > bound else top_k(df, col, k)


def pending(passed: DataFrame, done: DataFrame, key: str = "domain") -> DataFrame:
    """Rows whose key has no record in `done`."""
    return passed.join(done.select(key).distinct(), key, "left_anti")


def in_both(left: DataFrame, right: DataFrame, key: str = "domain") -> DataFrame:
    """Keys present on both sides."""
    return left.select(key).intersect(right.select(key))


def only_in_first(left: DataFrame, right: DataFrame, key: str = "domain") -> DataFrame:
    """Distinct keys of the first side that the second lacks."""
    return left.select(key).subtract(right.select(key))
