"""Places of pattern matches as Spark columns: code points, end exclusive."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiloom.session import materialize

SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` refers to it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def running(values: Column, block: int = 128) -> Column:
    """Running sums of an array of integers, in time about linear in its length.

    Sums grow by appending inside blocks of fixed length only, then every block is shifted by the blocks before it.
    """
    none = F.array().cast("array<int>")
    last = lambda a: F.coalesce(F.get(a, F.size(a) - 1), F.lit(0))
    append = lambda a, v: F.concat(a, F.array(last(a) + v))

    def of_blocks(own: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / block).cast("int")), lambda i: F.slice(own, i * block + 1, block))
        return F.transform(blocks, lambda part: F.aggregate(part, none, append))

    def shifted(sums: Column) -> Column:
        before = F.aggregate(sums, F.array(F.lit(0)), lambda a, part: append(a, last(part)))
        return let(before, lambda carried: F.flatten(F.transform(sums, lambda part, i: F.transform(part, lambda v: v + F.get(carried, i)))))

    return let(values, lambda own: F.when(F.size(own) > 0, let(of_blocks(own), shifted)).otherwise(none))


def found(text: Column, pattern: str, group: int = 0, needs: Column | None = None) -> Column:
    """Leftmost non-overlapping matches: array of (start, end, value), ``value`` being a group that ends the match.

    The matches and the pieces between them come from the same left-to-right search, so running lengths of both
    give the places. ``start`` is that of the whole match; the group starts at ``end - length(value)``. Only texts
    with a match pay for more than one search, and texts without what every match ``needs`` for none.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    sizes = lambda a: F.transform(a, lambda p: F.length(p))
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def placed(m: Column) -> Column:
        # a match ends where the pieces up to it and the matches up to it end
        before = F.slice(sizes(F.split(text, pattern, -1)), F.lit(1), F.size(m["size"]))
        ends = running(F.zip_with(before, m["size"], lambda a, b: a + b))
        return let(F.struct(ends.alias("end"), m["size"].alias("size"), m["value"].alias("value")), lambda r: F.transform(
            F.arrays_zip(r["end"].alias("end"), r["size"].alias("size"), r["value"].alias("value")),
            lambda x: F.struct((x["end"] - x["size"]).alias("start"), x["end"].alias("end"), x["value"].alias("value"))))

    some = text.rlike(pattern) if needs is None else needs & text.rlike(pattern)
    return F.when(some, let(F.struct(sizes(matches).alias("size"), values.alias("value")), placed)).otherwise(none)


def as_spans(matches: Column, kind: str, rank: int, keep: Callable[[Column], Column] | None = None, whole: bool = True) -> Column:
    """Spans of one kind; ``whole=False`` takes the value's place instead of the match's."""
    kept = F.filter(matches, keep) if keep else matches
    start = (lambda m: m["start"]) if whole else (lambda m: m["end"] - F.length(m["value"]))
    return F.transform(kept, lambda m: F.struct(start(m).alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"), F.lit(kind).alias("kind"))).cast(SPAN)


def in_order(*spans: Column) -> Column:
    """All spans by start, then kind as listed; no span stands in two of the arrays."""
    return F.array_sort(F.concat(*spans))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def outside(spans: Column, others: Column) -> Column:
    """The spans that overlap none of ``others``."""
    return F.filter(spans, lambda s: ~F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"])))


def text_key(text: Column) -> list[Column]:
    """Equal texts share their findings: 128 bits name a text."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.reverse(text), F.lit(17)).alias("h2")]


HIDDEN = ("__found", "__h1", "__h2")


def read_once(
    docs: DataFrame, text: str, keep: list[str] | None, base: Callable[[Column], Column], candidates: Callable[[Column, Column], Column],
) -> DataFrame:
    """The one pass over the texts, written: the kept columns, ``base`` and, where there are any, ``candidates`` with the text's key."""
    kept = [c for c in docs.columns if c not in ("base", "spans") and (keep is None or c in keep)]
    whole = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    # behind ``inline`` the base spans are a column: the optimizer cannot copy their expression into each use
    found = docs.select(*[f"`{c}`" for c in kept], F.inline(F.array(F.struct(whole.alias("__text"), base(whole).alias("base")))))
    found = found.select(*[f"`{c}`" for c in kept], "base", "__text", candidates(F.col("__text"), F.col("base")).alias("__found"))
    some = F.size("__found") > 0
    keys = [F.when(some, key).alias(name) for key, name in zip(text_key(F.col("__text")), HIDDEN[1:])]
    return materialize(found.select(*[f"`{c}`" for c in kept], "base", "__found", *keys), "texts")


def of_texts(table: DataFrame) -> DataFrame:
    """(h1, h2, base, found) of every distinct text with candidates."""
    some = table.filter(F.size("__found") > 0)
    return some.groupBy(F.col("__h1").alias("h1"), F.col("__h2").alias("h2")).agg(F.any_value("base").alias("base"), F.any_value("__found").alias("found"))


def with_more(table: DataFrame, more: DataFrame) -> DataFrame:
    """``table`` with its ``base`` spans, and those that ``more`` (h1, h2, extra) adds, as ``spans``.

    Only rows with candidates meet ``more``; the others stay where they are.
    """
    none = F.array().cast(SPAN)
    plain = table.filter(F.size("__found") == 0).withColumn("spans", F.col("base")).drop(*HIDDEN)
    rich = table.filter(F.size("__found") > 0).join(more.withColumnsRenamed({"h1": "__h1", "h2": "__h2", "extra": "__extra"}), ["__h1", "__h2"], "left")
    rich = rich.withColumn("spans", in_order(F.col("base"), F.coalesce(F.col("__extra"), none))).drop(*HIDDEN, "__extra")
    return plain.unionByName(rich.select(*[f"`{c}`" for c in plain.columns]))


def masked(text: Column, spans: Column, by: str) -> Column:
    """The text with every span's characters replaced by ``by``, overlapping spans as one."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        kept = F.when(fresh, F.concat(F.substring(text, done["at"] + 1, s["start"] - done["at"]), F.lit(by))).otherwise(F.lit(""))
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), F.concat(done["out"], kept).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(
        F.aggregate(spans, state, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.length(text)))))
