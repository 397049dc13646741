"""Secrets in texts, by one automaton over all rules."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automaton import RuleScanner
from .common import raw, slices

SPANS = "array<struct<kind:string,start:int,end:int>>"
#: The three rules whose spans are counted and digested.
BASE_KINDS = ("assign", "access", "hex")


@dataclass(frozen=True)
class Rule:
    """``least``: characters that ``group`` of a match (0: all of it) must have, else the match is dropped."""

    kind: str
    pattern: str
    either_case: bool = False
    group: int = 0
    least: int = 0


# The base rules, then public key formats.
RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]+", least=40),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]+", least=15),
    Rule("cloud_api", r"AIza[A-Za-z0-9_-]+", least=39),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]+", least=24),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=36),
    Rule("pem", r"-----BEGIN ([A-Z]+ )*PRIVATE KEY-----"),
)


def code_points(data: bytes, offsets: list[int]) -> list[int]:
    """Byte offsets of a UTF-8 text as code point offsets."""
    if data.isascii():
        return offsets
    heads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80
    before = np.concatenate(([0], np.cumsum(heads)))
    return before[offsets].tolist()


class SecretFinder:
    """Spans of one text: (kind, start, end) in code points, by start and then by rule."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.scanner = RuleScanner([(r.pattern, r.either_case) for r in rules])
        self.groups = [re.compile(r.pattern.encode(), re.I if r.either_case else 0) if r.least else None for r in rules]

    def spans(self, data: bytes) -> list[tuple[str, int, int]]:
        found = []
        for k, start, end in self.scanner.matches(data):
            rule, group = self.rules[k], self.groups[k]
            if group is None or len(group.fullmatch(data, start, end)[rule.group]) >= rule.least:
                found.append((start, k, end))
        found.sort()
        starts, ends = (code_points(data, [x[i] for x in found]) for i in (0, 2)) if found else ((), ())
        return [(self.rules[k].kind, a, b) for (_, k, _), a, b in zip(found, starts, ends)]


def find_secrets(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES
) -> DataFrame:
    """(doc_id, spans) for every row; spans are (kind, start, end) by start, then by rule order.

    Offsets are code points, ends exclusive. Matches are leftmost and longest,
    and do not overlap within a kind; kinds may overlap. Null and empty texts
    have no spans, repeated rows are all returned, null ids stay null, other
    columns are ignored.
    """

    sent = docs.sparkSession.sparkContext.broadcast(SecretFinder(rules))  # compiled once

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = sent.value
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in slices(batches):
            found = [[dict(zip(("kind", "start", "end"), s)) for s in finder.spans(t)] for t in raw(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(run, f"doc_id long, spans {SPANS}")
