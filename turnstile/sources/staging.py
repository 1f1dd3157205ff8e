"""Files parsed once: their rows are kept on shared storage, with marks of what could not be read.

Whatever is asked of the files afterwards, their sound rows, those left out, counts per file, reads the copy's
columns, not the files. Totals come from the pass that writes the copy.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from turnstile.session import scratch_path, written_copy
from turnstile.sources.files import same_path, without_files


@dataclass(frozen=True)
class Staged:
    """Parsed rows with ``_path``, ``filename`` and ``_bad``; the files they came from; totals by name."""

    rows: DataFrame
    listing: DataFrame
    totals: dict[str, int]

    def sound(self) -> DataFrame:
        """Rows of files without any bad row: a file counts as a whole or not at all.

        The bad files are written down as a short table, so that the planner knows its size and does not
        send all rows through a shuffle to meet it.
        """
        if not self.totals["n_bad"]:
            return self.rows
        return without_files(self.rows, written_copy(self.bad_files(), "bad-files"), "_path")

    def bad_files(self) -> DataFrame:
        """Name and path of files that hold a bad row; they are folded in each task that reads the marks."""
        return self.rows.filter("_bad").select("filename", "_path").distinct()

    def per_file(self, **counts: Column) -> DataFrame:
        """One row per file, those without rows too: name, size and ``counts`` over its rows."""
        folded = self.rows.groupBy(same_path(F.col("_path")).alias("path")).agg(*(c.alias(name) for name, c in counts.items()))
        return self.listing.join(folded, "path", "left")


def observed(df: DataFrame, name: str, **totals: Column) -> tuple[DataFrame, Observation]:
    """``df`` with totals that are known once it has been written."""
    seen = Observation(name)
    return df.observe(seen, *(c.alias(n) for n, c in totals.items())), seen


def seen_totals(seen: Observation, *names: str) -> dict[str, int]:
    """The totals of an observed frame after its write; 0 where no row came by."""
    found = seen.get
    return {name: int(found.get(name) or 0) for name in names}


def stage(parsed: DataFrame, listing: DataFrame, purpose: str, **totals: Column) -> Staged:
    """Write parsed rows once; count rows, bad rows and ``totals`` meanwhile."""
    totals = {"n_rows": F.count("*"), "n_bad": F.count_if("_bad"), **totals}
    watched, seen = observed(parsed, purpose, **totals)
    path = scratch_path(parsed.sparkSession, purpose)
    watched.write.parquet(path)
    copy = parsed.sparkSession.read.schema(parsed.schema).parquet(path)
    return Staged(copy, listing, seen_totals(seen, *totals))
