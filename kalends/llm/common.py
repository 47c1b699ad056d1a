"""What the operators share: words, work columns, the library's lineage cuts and connected components."""

from __future__ import annotations

from pyspark.sql import DataFrame

from kalends.operators.graph import components, cut, forget, join_counted, shared_dir, written

__all__ = ["BLANKS", "WORD", "clear", "components", "forget", "free", "join_counted", "materialize", "shared_dir", "written"]

#: A word is a run of anything but the six ASCII blanks; fixed by the query contracts.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = r"[\x20\x09-\x0D]+"

materialize = cut


def free(df: DataFrame, *names: str) -> list[str]:
    """Names for work columns that no column of ``df`` has, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    prefix = "__"
    while any(f"{prefix}{n}".lower() in taken for n in names):
        prefix += "_"
    return [prefix + n for n in names]


def clear(df: DataFrame) -> str:
    """A prefix that no column of ``df`` starts with."""
    prefix = "_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix
