"""Secret scans: rules find their candidate texts in a trigram index, regexes verify them.

Each Arrow batch is a block of the document-partitioned index: postings are built for the trigrams
that the rules' Boolean queries name, intersected, and only candidate texts are searched with the
regex. Rules without mandatory trigrams (long hex runs) search every text of the block. All work
stays with the rows, so nothing is shuffled and memory is bounded by one batch.

NULL and empty texts hold no spans. Texts are searched whole, repeated rows each on their own; other
columns pass through, a column of the output's name is replaced. An empty table gives an empty one.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import bounded_batches, whole_text
from newsloom.llm.trigrams import BlockIndex, trigram_query

SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"
_ARROW_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


@dataclass(frozen=True)
class Rule:
    """`least` characters are asked of group `group`; shorter matches are dropped once found."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: Fixed patterns of the base kinds, in the order that ties in `start` follow.
BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)

#: Well-known public token formats that the base kinds do not name.
MORE_RULES = (
    Rule("private_key", r"-----BEGIN (?:[A-Z0-9]+ ){0,3}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
)
RULES = BASE_RULES + MORE_RULES


def find_in_block(texts: list[str], rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """Per text its (start, rule number, end), sorted."""
    index = BlockIndex(texts)
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for number, rule in enumerate(rules):
        regex = re.compile(rule.pattern, re.ASCII)
        for row in index.candidates(trigram_query(rule.pattern)):
            for m in regex.finditer(texts[row]):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[row].append((m.start(), number, m.end()))
    for spans in found:
        spans.sort()
    return found


def _texts(column: pa.Array) -> list[str]:
    return [t or "" for t in column.to_pylist()]


def spans_of(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """All spans of a text by start, then rule: positions in code points, the end exclusive."""

    @F.arrow_udf(SPAN_TYPE)
    def spans(column: pa.Array) -> pa.Array:
        rows = [[{"kind": rules[n].kind, "start": s, "end": e} for s, n, e in found] for found in find_in_block(_texts(column), rules)]
        return pa.array(rows, type=_ARROW_TYPE)

    return spans(text)


def redacted(text: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text with each span replaced by its kind in angle brackets; overlapping spans become one."""

    @F.arrow_udf("string")
    def redact(column: pa.Array) -> pa.Array:
        values = column.to_pylist()
        for row, found in enumerate(find_in_block([t or "" for t in values], rules)):
            if not found:
                continue
            parts, at = [], 0
            for start, number, end in found:
                if start >= at:
                    parts += [values[row][at:start], f"<{rules[number].kind}>"]
                at = max(at, end)
            values[row] = "".join(parts) + values[row][at:]
        return pa.array(values, type=pa.string())

    return redact(text)


def scan(docs: DataFrame, text: str = "text", rules: tuple[Rule, ...] = RULES, output: str = "spans") -> DataFrame:
    """`docs` with the spans of their texts."""
    bounded_batches(docs.sparkSession)
    return docs.withColumn(output, spans_of(whole_text(text), rules))


def digest(found: DataFrame, rules: tuple[Rule, ...] = BASE_RULES, spans: str = "spans") -> DataFrame:
    """Counts per base kind, the digest of the base spans and all spans as text, per document."""
    base = [r.kind for r in rules]

    def joined(column: Column) -> Column:
        shown = F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
        return F.array_join(shown, ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in base],
        F.sha2(joined(F.filter(spans, lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col(spans)).alias("spans"),
    )
