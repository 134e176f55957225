"""INT-9 / SET-2: declared integrity rules, compiled into one scan per table and one grouped pass.

A rule names its tables, columns and SQL conditions.  Compiled, every row of a
table becomes an array of *tokens*, exploded once: its key in each key space
it owns, the keys it refers to, its legs and cached sums, and the row checks it
fails.  The tokens of all tables meet in one aggregate, combined per task, in
which a group knows how many rows own its key, how many refer to it and what
its sums are.  Only groups that break a rule are kept (checkpointed).

What cannot be told per group is told by reading again, and only where the
groups say that it is needed: the rows that refer to a missing key, and the
cached sums of a key that several rows own.

Most groups are a single token, so what a task holds follows the rows it reads:
the files are read in small splits, and the groups are summed up in partitions
that grow in number with the legs.  Tasks of a whole block of files outgrow
their memory and spill their tokens several times over.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.columns import MONEY, MONEY_SUM

VIOLATION = "rule string, entity string, entity_key string, detail string"
GROUP = ["space", "k1", "k2", "k3", "at"]
#: Broken keys that are sent to every task when rows are read again; more of them are joined by a shuffle.
BROADCAST_KEYS = 200_000
#: Bits by whose hash a row may refer to one of many broken keys (in bitmaps of 4 KB, 16 MB in all).
MAYBE_BITS = 1 << 27
BITMAP_BITS = 1 << 15
#: Bytes of stored rows whose tokens one task combines, what opening a file counts as, and bytes that one task sums up.
SPLIT_BYTES = 4 << 20
OPEN_BYTES = 512 << 10
SUM_BYTES = 16 << 20
#: Legs whose groups (about three a leg are left of its tokens) meet in one partition.
SUM_LEGS = 300_000
#: Equal violations that one generator call writes.
REPEATS = 10_000


class Check(NamedTuple):
    """Rows of ``table`` for which ``bad`` holds."""
    rule: str
    table: str
    entity: str
    key: str
    bad: str
    detail: str


class Unique(NamedTuple):
    """At most one row of ``table`` per value of ``columns`` (null is a value)."""
    name: str
    table: str
    columns: tuple[str, ...]


class Reference(NamedTuple):
    """``columns`` of ``table`` are in ``parent_columns`` of ``parent``; a null in them refers to nothing."""
    rule: str
    entity: str
    table: str
    key: str
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


class Balanced(NamedTuple):
    """Debits and credits of ``table`` (type, amount) are equal per value of ``columns``."""
    rule: str
    entity: str
    table: str
    columns: tuple[str, ...]


class Cached(NamedTuple):
    """``cached`` of ``table`` equals credits less debits of ``legs`` per ``key``."""
    rule: str
    entity: str
    table: str
    key: str
    cached: str
    legs: str


Rule = Check | Unique | Reference | Balanced | Cached


class Compiled:
    """The key spaces of a rule set and the tokens of its tables.

    A space is (kind, table, columns): a key that is unique and referred to is one space.
    """

    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.spaces: list[tuple] = []
        self.tokens: dict[str, list] = {}
        self.checks: dict[str, list] = {}
        owned = set()

        def own(table, columns):
            if (table, columns) not in owned:
                owned.add((table, columns))
                self._token(table, ("key", table, columns), columns, own="1L")

        for r in rules:
            if isinstance(r, Check):
                self._space(("check", r))
                self.checks.setdefault(r.table, []).append(r)
                self.tokens.setdefault(r.table, [])
            elif isinstance(r, Unique):
                own(r.table, r.columns)
            elif isinstance(r, Reference):
                own(r.parent, r.parent_columns)
                self._token(r.table, ("key", r.parent, r.parent_columns), r.columns, when=_all_there(r.columns), refs="1L")
            elif isinstance(r, Balanced):
                self._token(r.table, ("sums", r), r.columns, **_legs())
            else:
                self._token(r.table, ("cached", r), (r.key,), own="1L", cached=r.cached)
                self._token(r.legs, ("cached", r), (r.key,), when=_all_there((r.key,)), **_legs())

    def _space(self, space: tuple) -> int:
        if space not in self.spaces:
            self.spaces.append(space)
        return self.spaces.index(space)

    def _token(self, table, space, columns, when=None, **measures):
        self.tokens.setdefault(table, []).append((self._space(space), columns, when, measures))

    def of(self, name: str, df: DataFrame) -> DataFrame:
        """The tokens of one table: one scan, one generator."""
        types = dict(df.dtypes)
        keys = [_struct(space, [(c, types[c]) for c in columns], when, measures)
                for space, columns, when, measures in self.tokens[name]]
        checks = self.checks.get(name, [])
        failed = [_struct(self._space(("check", c)), [(c.key, "string"), (c.detail, "string")], c.bad, {"own": "1L"})
                  for c in checks]
        tokens = F.array(*keys) if keys else None
        if failed:
            any_bad = F.expr(" or ".join(f"({c.bad})" for c in checks))
            some = F.when(any_bad, F.array(*keys, *failed))
            tokens = some if tokens is None else some.otherwise(tokens)
        return df.select(F.explode(tokens).alias("t")).where("t is not null").select("t.*")


def _all_there(columns) -> str:
    return " and ".join(f"{c} is not null" for c in columns)


def _legs() -> dict:
    return {"debits": "case when type = 'DEBIT' then amount end", "credits": "case when type = 'CREDIT' then amount end"}


def _key(parts: list[tuple[str, str]]) -> list[Column]:
    """k1, k2, k3 and at of a key: a time keeps its type, all else is text."""
    texts = [F.expr(c).cast("string") for c, t in parts if not t.startswith("timestamp")]
    times = [F.expr(c).cast("timestamp") for c, t in parts if t.startswith("timestamp")]
    if len(texts) > 3 or len(times) > 1:
        raise ValueError(f"a key has up to three columns and a time: {parts}")
    none = F.lit(None)
    return [*(texts + [none.cast("string")] * 3)[:3], (times + [none.cast("timestamp")])[0]]


def _struct(space: int, parts, when, measures) -> Column:
    types = {"own": "long", "refs": "long", "debits": MONEY, "credits": MONEY, "cached": MONEY_SUM}
    token = F.struct(F.lit(space).alias("space"), *[c.alias(n) for c, n in zip(_key(parts), GROUP[1:])],
                     *[F.expr(measures.get(m, "null")).cast(t).alias(m) for m, t in types.items()])
    return token if when is None else F.when(F.expr(when), token)


def broken_groups(tables: dict[str, DataFrame], compiled: Compiled) -> DataFrame:
    """The groups that break a rule or need a second look, checkpointed."""
    tokens = reduce(DataFrame.unionByName, [compiled.of(n, tables[n]) for n in compiled.tokens])
    groups = tokens.groupBy(*GROUP).agg(
        F.coalesce(F.sum("own"), F.lit(0)).alias("own"), F.coalesce(F.sum("refs"), F.lit(0)).alias("refs"),
        *[F.coalesce(F.sum(c), F.lit(0)).cast(MONEY_SUM).alias(c) for c in ("debits", "credits")],
        F.coalesce(F.max("cached"), F.lit(0)).cast(MONEY_SUM).alias("cached"))     # the one owner's; several are read again
    kinds = {k: [i for i, s in enumerate(compiled.spaces) if s[0] == k] for k in ("check", "key", "sums", "cached")}
    broken = (F.col("space").isin(kinds["check"])
              | (F.col("space").isin(kinds["key"]) & ((F.col("own") > 1) | ((F.col("own") == 0) & (F.col("refs") > 0))))
              | (F.col("space").isin(kinds["sums"]) & (F.col("debits") != F.col("credits")))
              | (F.col("space").isin(kinds["cached"]) & ((F.col("own") > 1) | ((F.col("own") == 1) & (_drift() != 0)))))
    # legs are counted from the footers of their files
    legs = max((tables[t].count() for t in {t for r in compiled.rules for t in _leg_tables(r)}), default=0)
    spark = groups.sparkSession
    with small_tasks(spark, math.ceil(legs / SUM_LEGS)):
        return groups.where(broken).checkpoint(eager=True)


def _leg_tables(rule: Rule) -> list[str]:
    return [rule.table] if isinstance(rule, Balanced) else [rule.legs] if isinstance(rule, Cached) else []


@contextmanager
def small_tasks(spark: SparkSession, tasks: int) -> Iterator[None]:
    """While it holds, plans that are run read files in small splits and shuffle into at least ``tasks`` partitions,
    which are merged up to ``SUM_BYTES`` only."""
    def bytes_of(value):
        return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(value)
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions"]
    before = [spark.conf.get(n) for n in names]
    now = [min(most, bytes_of(b)) for most, b in zip((SPLIT_BYTES, OPEN_BYTES, SUM_BYTES), before, strict=False)]
    for n, value in zip(names, [*now, max(tasks, int(before[-1]))], strict=True):
        spark.conf.set(n, str(value))
    try:
        yield
    finally:
        for n, value in zip(names, before, strict=True):
            spark.conf.set(n, value)


def _drift() -> Column:
    return (F.col("cached") - (F.col("credits") - F.col("debits")).cast(MONEY_SUM)).cast(MONEY_SUM)


def _named(df: DataFrame, rule: str, entity: str, key: Column, detail: Column) -> DataFrame:
    return df.select(F.lit(rule).alias("rule"), F.lit(entity).alias("entity"), key.cast("string").alias("entity_key"),
                     detail.cast("string").alias("detail"))


def _joined_key() -> Column:
    return F.concat_ws("|", "k1", "k2", "k3", F.col("at").cast("string"))


def _again(rows: DataFrame, broken: DataFrame, n: int, how: str) -> DataFrame:
    """Rows whose key (GROUP but the space) is broken; few broken keys travel, for many their bitmaps do, and the rows
    these let through are joined by a shuffle."""
    few = n <= BROADCAST_KEYS
    rows = rows if few else _maybe(rows, broken)
    same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(broken[c]) for c in GROUP[1:]])
    return rows.join(F.broadcast(broken) if few else broken, same, how)


def _maybe(rows: DataFrame, broken: DataFrame) -> DataFrame:
    """All rows whose key is broken, and of the others about one in ``MAYBE_BITS`` / broken keys."""
    bit = F.pmod(F.xxhash64(*GROUP[1:]), F.lit(MAYBE_BITS))
    bucket, at = F.floor(bit / BITMAP_BITS).alias("_bucket"), bit % BITMAP_BITS
    maps = broken.select(bucket, at.alias("_bit")).groupBy("_bucket").agg(F.bitmap_construct_agg("_bit").alias("_map"))
    byte = F.conv(F.hex(F.substring("_map", (F.col("_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    # MAYBE_BITS / BITMAP_BITS rows at most
    return (rows.select("*", bucket, at.alias("_bit")).join(F.broadcast(maps), "_bucket")
            .where(F.getbit(byte, (F.col("_bit") % 8).cast("int")) == 1).select(*[rows[c] for c in rows.columns]))


def violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """All violations of ``rules``: rule, entity, entity_key, detail; one row per broken row or key.

    ``tables`` maps the names that the rules use to DataFrames; rows may repeat, any column may be null, an empty
    table breaks nothing, other columns are not read.
    """
    compiled = Compiled(rules)
    broken = broken_groups(tables, compiled)
    # two numbers a space
    found = {r["space"]: r for r in broken.groupBy("space").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("own") > 1).alias("many"), F.count_if(F.col("own") == 0).alias("missing")).collect()}
    parts = []
    for i, (kind, *what) in enumerate(compiled.spaces):
        if i not in found:
            continue
        mine = broken.where(F.col("space") == i)
        if kind == "check":
            c = what[0]
            # a third of all rows may break one rule with one key (null) and one detail
            runs = (mine.select("*", F.explode(F.sequence(F.lit(0), F.col("own") - 1, F.lit(REPEATS))).alias("_from"))
                    .repartition("k1", "k2", "_from"))
            parts.append(_named(runs.select("*", F.explode(F.sequence("_from", F.least(F.col("own"), F.col("_from") + REPEATS) - 1))),
                                c.rule, c.entity, F.col("k1"), F.col("k2")))
        elif kind == "sums":
            parts.append(_named(mine, what[0].rule, what[0].entity, _joined_key(),
                                F.concat_ws("/", F.col("debits").cast("string"), F.col("credits").cast("string"))))
        elif kind == "cached":
            r = what[0]
            parts.append(_named(mine.where("own = 1"), r.rule, r.entity, F.col("k1"), _drift()))
            if found[i]["many"]:
                rows = tables[r.table].select(*_aliased([(r.key, dict(tables[r.table].dtypes)[r.key])]),
                                              F.col(r.cached).cast(MONEY_SUM).alias("_cached"))
                both = _again(rows, mine.where("own > 1").drop("cached"), found[i]["many"], "inner")
                drift = (F.col("_cached") - (F.col("credits") - F.col("debits")).cast(MONEY_SUM)).cast(MONEY_SUM)
                parts.append(_named(both.where(drift != 0), r.rule, r.entity, rows["k1"], drift))
        else:
            parts += _key_violations(tables, compiled, what, mine, found[i])
    if not parts:
        return broken.sparkSession.createDataFrame([], VIOLATION)
    return reduce(DataFrame.unionByName, parts)


def _aliased(parts) -> list[Column]:
    return [c.alias(n) for c, n in zip(_key(parts), GROUP[1:])]


def _key_violations(tables, compiled: Compiled, what, mine: DataFrame, found) -> list[DataFrame]:
    table, columns = what
    parts = [_named(mine.where("own > 1"), "unique", r.name, _joined_key(), F.col("own"))
             for r in compiled.rules if isinstance(r, Unique) and (r.table, r.columns) == (table, columns)]
    if found["missing"]:
        missing = mine.where("own = 0")
        for r in compiled.rules:
            if isinstance(r, Reference) and (r.parent, r.parent_columns) == (table, columns):
                df = tables[r.table]
                types = dict(df.dtypes)
                rows = (df.where(_all_there(r.columns))
                        .select(F.col(r.key).cast("string").alias("_child"), *_aliased([(c, types[c]) for c in r.columns])))
                parts.append(_named(_again(rows, missing, found["missing"], "left_semi"), r.rule, r.entity, F.col("_child"),
                                    _joined_key()))
    return parts
