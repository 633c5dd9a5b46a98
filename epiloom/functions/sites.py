"""Column expressions over methylation sites."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .chemistry import IUPAC
from .seq import _col


def context_filter(context: Column | str, wanted: str, *, literal_prefix: bool = False) -> Column:
    """Trinucleotide context predicate; ``ALL`` or ``*`` passes everything.

    IUPAC codes match their bases (``CHG`` keeps ``CAG``). ``literal_prefix``
    compares the codes as plain text instead.
    """
    wanted = wanted.strip().upper()
    if wanted in ("ALL", "*"):
        return F.lit(True)
    column = F.upper(_col(context))
    if literal_prefix:
        return column.startswith(wanted)
    return column.rlike("^" + "".join(f"[{IUPAC[b]}]" if b in IUPAC and len(IUPAC[b]) > 1 else b for b in wanted))


def main_chromosome(chrom: Column | str) -> Column:
    return _col(chrom).rlike("^chr([0-9]+|X|Y|M)$")


def parse_contigs(text: str) -> list[str]:
    """Comma-separated contig names; blanks are dropped."""
    return sorted({part.strip() for part in text.split(",") if part.strip()})


def contig_filter(
    chrom: Column | str, *, exclude: Iterable[str] = (), main_only: bool = False
) -> Column:
    keep = F.lit(True)
    exclude = list(exclude)
    if exclude:
        keep = keep & ~_col(chrom).isin(exclude)
    if main_only:
        keep = keep & main_chromosome(chrom)
    return keep


def encode_site(mc: Column | str, cov: Column | str, *, round_sites: bool = False) -> Column:
    """+1 methylated, -1 unmethylated, NULL for uncovered, mixed or tied sites.

    ``round_sites`` resolves a mixed site by majority instead of dropping it.
    """
    mc, cov = _col(mc), _col(cov)
    unmeth = cov - mc
    mixed = (mc != 0) & (unmeth != 0)
    if round_sites:
        resolved = F.when(mc > unmeth, 1).when(mc < unmeth, -1)
    else:
        resolved = F.lit(None)
    code = (
        F.when(cov <= 0, F.lit(None))
        .when(mixed, resolved)
        .otherwise(F.when(mc > 0, 1).otherwise(-1))
    )
    return code.cast("tinyint")


def is_cg(context: Column | str) -> Column:
    return F.substring(_col(context), 2, 1) == "G"


def region_name(chrom: Column | str, start: Column | str, end: Column | str) -> Column:
    return F.format_string("%s:%d-%d", _col(chrom), _col(start), _col(end))


def region_label(path: str, override: str | None = None) -> str:
    """File stem of the region file, or the override."""
    if override and override.strip():
        return override.strip()
    return path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0] or "regions"
