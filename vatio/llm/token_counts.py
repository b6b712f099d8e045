"""Token counts by offset-mapped attribution: a document is encoded once and
whole, its tokens' character spans are joined to the spans of its sections, and
a token that crosses a border is allocated by a stated rule.

Tokens and sections are both sorted, so the interval join is a merge: binary
searches of one's borders in the other's. It is done where the text lies; the
counts of a document's sections leave the task, its tokens never do."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship
from .secret_scan import VOCABULARY, encoding, read_vocabulary

#: To whom a token goes that overlaps several sections: the section of its first
#: character, of its last one, the one with most of its characters (the first of
#: equals), or all of them in proportion to their characters of it.
RULES = ("first", "last", "most", "share")
_LENGTHS: dict = {}


def lines(text: str) -> list[tuple[int, int]]:
    """Sections of a text: its lines with their line ends; an empty text has one."""
    ends = [m.end() for m in re.finditer(r"\n", text)]
    if not ends or ends[-1] < len(text):
        ends.append(len(text))
    return list(zip([0, *ends[:-1]], ends))


def token_spans(text: str, tokens: list[int], lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Character spans (start, end exclusive) of byte-level tokens. A token that
    begins or ends inside a character's bytes spans the whole character."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    ends = np.cumsum(lengths[np.asarray(tokens, dtype=np.int64)]) if tokens else np.empty(0, np.int64)
    starts = np.concatenate(([0], ends[:-1])) if tokens else ends
    if len(raw) == len(text):
        return starts, ends
    character = np.cumsum((raw & 0xC0) != 0x80)  # characters begun up to and with a byte
    return character[starts] - 1, character[ends - 1]


def allocate(starts: np.ndarray, ends: np.ndarray, sections: list[tuple[int, int]],
             rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section by the rule, and how many of them cross one of its
    borders. ``sections``: adjacent spans that cover the text."""
    n = len(sections)
    if not len(starts):
        return np.zeros(n), np.zeros(n, np.int64)
    borders = np.array([b for _, b in sections])
    first = np.minimum(np.searchsorted(borders, starts, side="right"), n - 1)
    last = np.minimum(np.searchsorted(borders, ends, side="left"), n - 1)
    cross = np.flatnonzero(last > first)
    counts = np.bincount(last if rule == "last" else first, minlength=n).astype(float)
    crossing = np.zeros(n, np.int64)
    for t in cross.tolist():  # few: tokens with a line end inside
        a, b = int(first[t]), int(last[t])
        crossing[a:b + 1] += 1
        if rule in ("most", "share"):
            parts = [min(ends[t], sections[k][1]) - max(starts[t], sections[k][0]) for k in range(a, b + 1)]
            counts[a] -= 1
            if rule == "most":
                counts[a + int(np.argmax(parts))] += 1
            else:
                counts[a:b + 1] += np.array(parts) / sum(parts)
    return counts, crossing


def section_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: str = "first",
                   vocabulary_path: str = VOCABULARY,
                   sections: Callable[[str], list[tuple[int, int]]] = lines) -> DataFrame:
    """One row per document and section: doc_id, section (from 0), start, end
    (code points), tokens (double; whole but for the rule "share"), crossing
    (tokens that overlap the section and another one) and doc_tokens.

    The sections' tokens add up to ``doc_tokens``, the length of the encoding of
    the whole text. Null texts count as empty: one section without tokens.
    Repeated rows give repeated results; other columns are ignored. A
    projection: no shuffle, one document at a time.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    ship(docs)
    vocabulary = read_vocabulary(vocabulary_path)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(vocabulary)
        lengths = _LENGTHS.get(id(enc))
        if lengths is None:
            lengths = _LENGTHS[id(enc)] = np.array([len(enc.decode_single_token_bytes(i)) for i in range(enc.n_vocab)])
        columns = ("doc_id", "section", "start", "end", "tokens", "crossing", "doc_tokens")
        for b in batches:
            out: dict[str, list] = {c: [] for c in columns}
            for i, t in zip(b["doc_id"].tolist(), b["text"].tolist()):
                t = t or ""
                spans = sections(t)
                tokens = enc.encode_ordinary(t)
                counts, crossing = allocate(*token_spans(t, tokens, lengths), spans, rule)
                n = len(spans)
                out["doc_id"] += [i] * n
                out["section"] += range(n)
                out["start"] += [s for s, _ in spans]
                out["end"] += [e for _, e in spans]
                out["tokens"] += counts.tolist()
                out["crossing"] += crossing.tolist()
                out["doc_tokens"] += [len(tokens)] * n
            yield pd.DataFrame(out)

    # Ids travel as text: a null among numbers would turn them into floating point.
    kind = docs.schema[doc_id].dataType
    rows = docs.select(F.col(doc_id).cast("string").alias("doc_id"), F.col(text).alias("text")).mapInPandas(
        count, "doc_id string, section int, start int, end int, tokens double, crossing int, doc_tokens int")
    return rows.withColumn("doc_id", F.col("doc_id").cast(kind))


def document_tokens(text: Column, vocabulary_path: str = VOCABULARY) -> Column:
    """Tokens of a whole text; null counts as empty."""
    vocabulary = read_vocabulary(vocabulary_path)

    @F.pandas_udf("long")
    def count(texts: pd.Series) -> pd.Series:
        encode = encoding(vocabulary).encode_ordinary
        return pd.Series([len(encode(t or "")) for t in texts], dtype="int64")
    return count(text)
