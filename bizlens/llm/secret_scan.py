"""Secrets in texts: spans of all rules, found in one pass of a combined automaton."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bizlens.llm.automaton import Rule, Scanner
from bizlens.llm.text import steps

_NAME = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
#: Named values, access keys and long hexadecimal numbers.
BASE = (
    Rule("assign", _NAME + r"[\x22\x27]?\x20*[:=]\x20*[\x22\x27]?", r"[A-Za-z0-9+/_.=\x2d]+", 6),
    Rule("access", "AKIA", "[A-Z0-9]+", 16),
    Rule("hex", "", "[0-9a-f]+", 24),
)
#: Published formats of tokens and keys; fixed values.  Each body that shares its signs with others multiplies the states.
MORE = (
    Rule("github", "gh[oprsu]_", "[A-Za-z0-9]+", 36),
    Rule("pem", "-----BEGIN ", "((RSA|DSA|EC|OPENSSH|ENCRYPTED) )?PRIVATE KEY-----"),
    Rule("slack", "xox[abprs]-", r"[A-Za-z0-9\x2d]+", 10),
    Rule("stripe", "[rs]k_live_", "[A-Za-z0-9]+", 16),
)
RULES = BASE + MORE
STEP = 2_000_000
SPAN = "array<struct<start:long,kind_no:int,kind:string,end:long>>"


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with the array ``spans`` of (start, kind_no, kind, end), ordered by start, then by the rules' order.

    Per rule the leftmost matches, none overlapping another, in code points, end exclusive.  Null and empty texts, and an empty
    table, have empty arrays or no rows; repeated rows are scanned like others.  A column of ``docs`` named like the spans is
    replaced; other columns stay as they are.  A text has to fit a task (about 20 bytes of memory a byte).
    """
    keep = [c for c in docs.columns if c != spans_col]
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    narrow = docs.select(kept.alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = [r.kind for r in rules]

    scanner = Scanner(list(rules))

    def scan(batches):
        for batch, data, starts in steps(batches, "text", STEP):
            text, rule, first, end = scanner.spans(data, starts)
            if len(text):
                points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80, dtype=np.int64)])
                at = starts[text]
                first, end = (points[x + at] - points[at] for x in (first, end))
            order = np.lexsort((rule, first, text))
            text, rule, first, end = (x[order] for x in (text, rule, first, end))
            offsets = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            items = pa.StructArray.from_arrays([pa.array(first), pa.array(rule.astype(np.int32)), pa.array([kinds[r] for r in rule], pa.string()),
                                                pa.array(end)], ["start", "kind_no", "kind", "end"])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.ListArray.from_arrays(pa.array(offsets), items)], ["row", "spans"])

    schema = narrow.select("row").schema.add("spans", narrow.sparkSession.createDataFrame([], f"s {SPAN}").schema["s"].dataType)
    found = narrow.mapInArrow(scan, schema)
    return found.select(*[F.col("row")[c].alias(c) for c in keep], F.col("spans").alias(spans_col))


def listed(spans: Column) -> Column:
    """Spans as ``kind:start:end``, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
