"""Read-level column expressions. Everything here is a built-in Spark expression."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import chemistry as chem


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def base_at(seq: Column | str, offset: int) -> Column:
    """The base at a 0-based offset ('' past the end)."""
    return F.substring(_col(seq), offset + 1, 1)


def parse_structure(structure: str) -> list[tuple[str, int, int]]:
    """``"B17U12"`` -> ``[("B", 0, 17), ("U", 17, 12)]`` (code, 0-based start, length)."""
    segments, start = [], 0
    for code, length in re.findall(r"([BLUXT])(\d+)", structure):
        segments.append((code, start, int(length)))
        start += int(length)
    return segments


def structure_column(seq: Column | str, structure: str, code: str) -> Column:
    """The upper-cased slice of ``seq`` that ``structure`` assigns to ``code``."""
    slices = [(start, length) for c, start, length in parse_structure(structure) if c == code]
    if not slices:
        raise ValueError(f"structure {structure!r} has no segment {code!r}")
    start, length = slices[-1]
    return F.upper(F.substring(_col(seq), start + 1, length))


def has_linker(seq: Column | str) -> Column:
    return F.substring(_col(seq), chem.LINKER_OFFSET + 1, len(chem.LINKER_SEQUENCE)) == F.lit(
        chem.LINKER_SEQUENCE
    )


def _long_enough(seq: Column) -> Column:
    return F.length(seq) > max(chem.PROBE_OFFSETS)


def insert_bases(seq: Column | str) -> Column:
    return F.concat(*[base_at(seq, o) for o in chem.INSERT_OFFSETS])


def ct_counts(seq: Column | str, qual: Column | str) -> Column:
    """``struct(c, t)`` of the convertible bases, or NULL when the read is not eligible.

    Eligible: linker present, long enough, mean probe quality at least 30, all
    insert bases T, and every convertible base C or T.
    """
    seq, qual = _col(seq), _col(qual)
    n = len(chem.CONVERTIBLE_OFFSETS)
    probe = F.concat(*[base_at(seq, o) for o in chem.CONVERTIBLE_OFFSETS])
    c = F.lit(n) - F.length(F.translate(probe, "C", ""))
    t = F.lit(n) - F.length(F.translate(probe, "T", ""))
    quality_sum = sum((F.ascii(base_at(qual, o)) - 33 for o in chem.PROBE_OFFSETS), F.lit(0))
    eligible = (
        has_linker(seq)
        & _long_enough(seq)
        & (quality_sum >= chem.MIN_PROBE_QUALITY * len(chem.PROBE_OFFSETS))
        & (insert_bases(seq) == "TTT")
        & (c + t == n)
    )
    return F.when(eligible, F.struct(c.cast("long").alias("c"), t.cast("long").alias("t")))


def chain_direction(seq: Column | str) -> Column:
    """``unknown`` for short reads, ``reverse`` if all insert bases are C, else ``forward``."""
    seq = _col(seq)
    return (
        F.when(~_long_enough(seq), "unknown")
        .when(insert_bases(seq) == "CCC", "reverse")
        .otherwise("forward")
    )


# --- adapter trimming -------------------------------------------------------


def _bases(adapter: str) -> list[str]:
    return [b if len(chem.IUPAC[b]) == 1 else f"[{chem.IUPAC[b]}]" for b in adapter]


def exact_pattern(adapter: str) -> str:
    return "".join(_bases(adapter))


def _expansions(bases: list[str]) -> list[str]:
    """The plain texts of a piece: one for each choice at its ambiguous bases."""
    out = [""]
    for base in bases:
        out = [text + b for text in out for b in base.strip("[]")]
    return out


def _edited(bases: list[str], edit: str, *, before_first: bool = False) -> str:
    """A pattern of ``bases`` with one base replaced (``sub``), one more (``ins``) or one less (``del``)."""
    places = range(len(bases)) if edit != "ins" or before_first else range(1, len(bases))
    rest = {"sub": 1, "ins": 0, "del": 1}[edit]
    any_base = "" if edit == "del" else "."
    return "(?:" + "|".join("".join(bases[:i]) + any_base + "".join(bases[i + rest :]) for i in places) + ")"


SPAN_CHANGE = {"sub": 0, "ins": 1, "del": -1}  # read bases of a placement beyond those of the adapter


def half_anchored_patterns(adapter: str, edit: str) -> tuple[str, str, int]:
    """Search patterns for ``adapter`` with one edit: (left, right, shift).

    One half is always free of errors. Each pattern starts with that half as
    plain text, which the regex engine finds by skipping, and only then tests
    the other half: ``left`` matches at the placement, ``right`` at ``shift``
    bases into it (the error-free right half, looking back).
    """
    bases = _bases(adapter)
    half = len(bases) // 2
    left, right = "".join(bases[:half]), "".join(bases[half:])
    return (
        left + _edited(bases[half:], edit, before_first=True),
        f"{right}(?<={_edited(bases[:half], edit)}{right})",
        half + SPAN_CHANGE[edit],
    )


def _first_of(column: Column, texts: list[str]) -> Column:
    """The 0-based place of the first of some plain texts, NULL if the read has none."""
    places = [F.nullif(F.instr(column, text), F.lit(0)) - 1 for text in texts]
    return F.least(*places) if len(places) > 1 else places[0]


def _may_be_partial(edge: Column, piece: str) -> Column:
    """A cheap necessary condition of :func:`_partial_pattern`, by plain texts.

    Of a part with at most one edit, one half is free of errors: the far half
    ends with the last bases of the adapter, the near half begins the read.
    """
    m, bases = len(piece), _bases(piece)
    size = chem.ADAPTER_MIN_OVERLAP - chem.ADAPTER_MIN_OVERLAP // 2
    near = {text for overlap in range(2 * size, m) for text in _expansions(bases[m - overlap : m - overlap + size])}
    found = F.left(edge, F.lit(size)).isin(sorted(near))
    for text in _expansions(bases[-size:]):
        found = found | F.contains(F.left(edge, F.lit(m + 1)), F.lit(text))
    return found


def _partial_placements(m: int, end: str) -> list[tuple[int, int, str | None]]:
    """(score, overlap, edit) of the placements of a part of an adapter at a read end, the preferred one first.

    At the start of a read, equal scores go to the shorter stretch of read, at its end to the larger overlap.
    """
    allowed = []
    for overlap in range(chem.ADAPTER_MIN_OVERLAP, m):
        edits = (None, "sub", "ins", "del") if int(overlap * chem.ADAPTER_ERROR_RATE) else (None,)
        allowed += [(_score(overlap, edit), overlap, edit) for edit in edits]
    span = lambda p: p[1] + SPAN_CHANGE.get(p[2], 0)
    return sorted(allowed, key=lambda p: (-p[0], span(p) if end == "5" else -p[1], span(p)))


def _score(bases: int, edit: str | None) -> int:
    """Matches count 1, a replaced base -1, an inserted or a missing one -2."""
    return bases - {None: 0, "sub": 2, "ins": 2, "del": 3}[edit]


def _partial_piece(adapter: str, overlap: int, edit: str | None) -> str:
    bases = _bases(adapter)[-overlap:]
    if edit is None:
        return "".join(bases)
    half = overlap // 2
    left, right = bases[:half], bases[half:]
    return f"(?:{''.join(left)}{_edited(right, edit, before_first=True)}|{_edited(left, edit)}{''.join(right)})"


def _partial_pattern(adapter: str, end: str, scores: tuple[int, ...] | None = None) -> str:
    """Adapter suffixes at the start of a read; the first alternative that fits is the preferred one."""
    pieces = (
        _partial_piece(adapter, overlap, edit)
        for score, overlap, edit in _partial_placements(len(adapter), end) if scores is None or score in scores
    )
    return "^(?:" + "|".join(pieces) + ")"


def staged(df: DataFrame, **columns: Column) -> DataFrame:
    """Compute columns once behind a one-row ``inline``.

    The optimizer would otherwise copy a long expression into each of its uses;
    for a chain of pattern searches those copies multiply.
    """
    keep = [c for c in df.columns if c not in columns]
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def with_adapter_match(
    df: DataFrame, seq: str, adapter: str, end: str, start_col: str, stop_col: str
) -> DataFrame:
    """Locate ``adapter`` and add 0-based ``[start, stop)`` columns (NULL when absent).

    Edit distance with indels: at most 10 % errors (one for a whole adapter and
    for parts of ten bases, none below), overlap at least 9, IUPAC codes match
    their bases. Score is matches minus replaced bases minus two for an inserted
    or missing one. Placements are met in the order of their ends (of those with
    one end the best score, then the shortest). The first one holds until one
    with a better score starts at most half an adapter further.
    Parts exist at the read start (``end="5"``, adapter suffix), where the best
    one comes first and any whole adapter of a better score replaces it, or at
    the read end (``end="3"``, adapter prefix), where the best one comes last.

    Only the first placement of each kind of edit can win, so each is one search
    for an error-free half. Reads without such a half are not searched, nor are
    those whose first halves are those of an exact adapter.
    """
    m, reach, half = len(adapter), len(adapter) // 2, len(adapter) // 2
    top, edited, shorter = m, _score(m, "sub"), _score(m, "del")
    column, bases = F.col(seq), _bases(adapter)
    # A 3' prefix at the end of a read is a suffix at the start of the reversed read.
    edge, piece = (column, adapter) if end == "5" else (F.reverse(column), adapter[::-1])
    fits = lambda *scores: edge.rlike(_partial_pattern(piece, end, scores))
    df = staged(
        df,
        _left=_first_of(column, _expansions(bases[:half])),
        _right=_first_of(column, _expansions(bases[half:])),
        _part=F.when(_may_be_partial(edge, piece), F.length(F.regexp_extract(edge, _partial_pattern(piece, end), 0))).otherwise(0),
    )
    part = F.when(F.col("_part") > 0, F.col("_part"))
    df = staged(df, _exact=F.when(F.col("_left").isNotNull() & F.col("_right").isNotNull(), _first_of(column, _expansions(bases))))
    at = F.col("_exact")
    plain = F.coalesce((F.col("_left") == at) & (F.col("_right") == at + half), F.lit(False))
    searched = (F.col("_left").isNotNull() | F.col("_right").isNotNull()) & ~plain

    def first(pattern: str, shift: int = 0) -> Column:
        place = F.regexp_instr(column, F.lit(pattern))
        return F.when(searched, F.when(place > 0, place - 1 - shift))

    def earliest(edit: str) -> Column:
        left, right, shift = half_anchored_patterns(adapter, edit)
        return F.least(first(left), first(right, shift))

    df = staged(
        df,
        _sub=earliest("sub"),
        _ins=earliest("ins"),
        _del=earliest("del"),
        # the score that a whole adapter must beat after a part at the start of a read, as far as it matters
        _held=F.when(part.isNull(), 0).when(fits(m - 1, m - 2), edited).when(fits(shorter), shorter).otherwise(0) if end == "5" else F.lit(0),
    )
    exact, sub, ins = F.col("_exact"), F.col("_sub"), F.col("_ins")
    held = F.col("_held")
    by_ins = sub.isNull() | (ins + 1 < sub)  # ends before the replaced one
    near = F.when(held < edited, F.when(ins.isNotNull() & by_ins, ins).otherwise(sub))
    near_end = F.when(held < edited, F.when(ins.isNotNull() & by_ins, ins + m + 1).otherwise(sub + m))
    short = F.when(held < shorter, F.col("_del"))
    df = staged(df, _near=near, _near_end=near_end, _short=short)
    near, near_end, short = F.col("_near"), F.col("_near_end"), F.col("_short")

    def placed(start: Column, stop: Column, score: int) -> Column:
        return F.struct(start.cast("int").alias("start"), stop.cast("int").alias("stop"), F.lit(score).alias("score"))

    whole = placed(exact, exact + m, top)
    from_near = F.when(exact <= near + reach, whole).otherwise(placed(near, near_end, edited))
    from_short = (
        F.when(near <= short + reach, from_near)
        .when(exact <= short + reach, whole)
        .otherwise(placed(short, short + m - 1, shorter))
    )
    none = F.lit(1 << 30)
    ends = [F.coalesce(c, none) for c in (exact + m, near_end, short + m - 1)]
    full = (
        F.when((ends[0] < none) & (ends[0] <= ends[1]) & (ends[0] <= ends[2]), whole)
        .when((ends[1] < none) & (ends[1] <= ends[2]), from_near)
        .when(ends[2] < none, from_short)
    )
    df = staged(df, _full=full)
    full = F.col("_full")
    if end == "5":
        start = F.when(full.isNotNull(), full["start"]).when(part.isNotNull(), 0)
        stop = F.coalesce(full["stop"], part)
    else:
        origin = F.length(column) - part
        longer = edge.rlike("^" + _partial_piece(piece, m - 1, None)) | ((full["score"] == shorter) & edge.rlike("^" + _partial_piece(piece, m - 2, None)))
        better = (full["score"] < m - 1) & (origin <= full["start"] + reach) & longer
        use_part = part.isNotNull() & (full.isNull() | better)
        start = F.when(use_part, origin).otherwise(full["start"])
        stop = F.when(use_part, F.length(column)).otherwise(full["stop"])
    return staged(df, **{start_col: start, stop_col: stop}).drop(
        "_left", "_right", "_part", "_exact", "_sub", "_ins", "_del", "_held", "_near", "_near_end", "_short", "_full")


def _trim_mate(df: DataFrame, mate: str, adapter5: str, adapter3: str) -> DataFrame:
    seq, qual = f"{mate}_seq", f"{mate}_qual"
    df = with_adapter_match(df, seq, adapter5, "5", "_start", "_stop")
    cut = F.coalesce(F.col("_stop"), F.lit(0)) + 1
    df = staged(
        df,
        **{n: F.substr(F.col(n), cut) for n in (seq, qual)},
        **{f"{mate}_left": F.col("_stop").isNotNull()},
    ).drop("_start", "_stop")
    df = with_adapter_match(df, seq, adapter3, "3", "_start", "_stop")
    length = F.coalesce(F.col("_start"), F.length(seq))
    return staged(
        df,
        **{n: F.substr(F.col(n), F.lit(1), length) for n in (seq, qual)},
        **{f"{mate}_right": F.col("_start").isNotNull()},
    ).drop("_start", "_stop")


def trim_adapters(df: DataFrame) -> DataFrame:
    """Trim ``r1_seq/r1_qual/r2_seq/r2_qual``; adds ``r{1,2}_left`` and ``r{1,2}_right`` hit flags."""
    df = _trim_mate(df, "r1", chem.READ1_ADAPTER_5, chem.READ1_ADAPTER_3)
    return _trim_mate(df, "r2", chem.READ2_ADAPTER_5, chem.READ2_ADAPTER_3)


def crop_insert(df: DataFrame) -> DataFrame:
    """Drop the non-insert bases that remain after trimming (read 1 capped at 63 bp)."""
    ext = chem.EXTENSION_LENGTH
    n1, n2 = F.length("r1_seq"), F.length("r2_seq")
    long1, long2 = n1 > chem.CROP_ONLY_ABOVE, n2 > chem.CROP_ONLY_ABOVE
    start1 = F.when(~long1, 0).when(F.col("r1_left"), ext).otherwise(chem.NON_INSERT_LENGTH)
    end1 = F.when(long1 & F.col("r1_right"), n1 - ext).otherwise(n1)
    end1 = F.when(long1, F.least(end1, start1 + chem.MAX_READ1_LENGTH)).otherwise(end1)
    start2 = F.lit(ext)
    end2 = F.when(long2 & F.col("r2_right"), n2 - ext).otherwise(n2)

    def cut(name: str, start: Column, end: Column) -> Column:
        return F.substr(F.col(name), start + 1, F.greatest(end - start, F.lit(0)))

    cropped = {
        "r1_seq": cut("r1_seq", start1, end1),
        "r1_qual": cut("r1_qual", start1, end1),
        "r2_seq": cut("r2_seq", start2, end2),
        "r2_qual": cut("r2_qual", start2, end2),
    }
    return staged(df, **cropped)


def long_enough_pair(r1: Column | str = "r1_seq", r2: Column | str = "r2_seq") -> Column:
    return (F.length(_col(r1)) >= chem.MIN_READ1_LENGTH) & (F.length(_col(r2)) >= chem.MIN_READ2_LENGTH)


def is_chimeric(
    r1: Column | str, r2: Column | str, chain: Column | str, threshold: int = chem.CHIMERIC_THRESHOLD
) -> Column:
    """Either mate holds more than ``threshold`` unconverted two-mers for its strand; 0 disables."""
    if threshold <= 0:
        return F.lit(False)
    expr = None
    for direction, (p1, p2) in chem.CHIMERIC_PATTERNS.items():
        hit = (F.regexp_count(_col(r1), F.lit(p1)) > threshold) | (
            F.regexp_count(_col(r2), F.lit(p2)) > threshold
        )
        expr = F.when(_col(chain) == direction, hit) if expr is None else expr.when(_col(chain) == direction, hit)
    return expr.otherwise(False)


# --- names and tags ---------------------------------------------------------


def demux_read_name(header, cb, umi, chain, tag) -> Column:
    """``@{cb}_{umi}_{chain}_{tag}_{original}:{cb}`` plus the original description, if any."""
    header = _col(header)
    original = F.substr(F.substring_index(header, " ", 1), F.lit(2))
    space = F.instr(header, " ")
    suffix = F.when(space > 0, F.substr(header, space)).otherwise("")
    name = F.concat(
        F.lit("@"), F.concat_ws("_", _col(cb), _col(umi), _col(chain), _col(tag), original),
        F.lit(":"), _col(cb), suffix,
    )
    bad = F.raise_error(F.concat(F.lit("invalid FASTQ header: "), header)).cast("string")
    return F.when(F.startswith(header, F.lit("@")), name).otherwise(bad)


def cell_from_read_name(name: Column | str) -> Column:
    return F.substring_index(_col(name), "_", 1)


def correction_tag(observed: Column | str, corrected: Column | str) -> Column:
    """``{i}{observed base}`` for every mismatch (0-based), ``M`` for an exact match."""
    observed, corrected = _col(observed), _col(corrected)
    diffs = F.transform(
        F.filter(
            F.sequence(F.lit(1), F.least(F.length(observed), F.length(corrected))),
            lambda i: F.substr(observed, i, F.lit(1)) != F.substr(corrected, i, F.lit(1)),
        ),
        lambda i: F.concat((i - 1).cast("string"), F.substr(observed, i, F.lit(1))),
    )
    return F.when(observed == corrected, "M").otherwise(F.array_join(diffs, ""))
