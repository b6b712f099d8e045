"""Secret scans: three fixed patterns, and a token-efficiency test that finds
random strings. A byte-pair vocabulary learnt from ordinary text spends many
tokens on a random string, so a run of secret-like characters with few
characters per token is reported, unless it is a known digest or identifier or
a name whose parts are words by the same test."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

# ---- Fixed values -----------------------------------------------------------
KINDS = ("assign", "access", "hex", "random")  # the order of kinds at one start
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ASSIGN_LENGTH = 6
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")      # AKIA[A-Z0-9]+ of 20 characters or more
HEX = re.compile(r"[0-9a-f]{24,}")             # runs of hex digits of 24 characters or more
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# -----------------------------------------------------------------------------
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Runs of this many secret-like characters are tested.
MIN_LENGTH = 16
#: Characters per token at or below which a run counts as random.
MAX_RATIO = 2.2
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % MIN_LENGTH)
#: Known digests (MD5, SHA-1, SHA-2 in hex) and identifiers: UUIDs, numbers and dates.
KNOWN = re.compile(r"(?:[0-9a-fA-F]{32}|[0-9a-fA-F]{40}|[0-9a-fA-F]{56}|[0-9a-fA-F]{64}|[0-9a-fA-F]{96}|[0-9a-fA-F]{128}"
                   r"|[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}"
                   r"|[0-9+/_=-]+)\Z")
#: The form of a name, or path of names, of letters and short numbers. Each run of
#: its letters still has to be a word.
NAME = re.compile(r"[/_=+-]*[A-Z]*[a-z]*[0-9]{0,4}(?:[/_=+-]+[A-Z]*[a-z]*[0-9]{0,4})*\Z")
LETTERS = re.compile(r"[A-Za-z]+")
_ENCODINGS: dict = {}


def read_vocabulary(path: str = VOCABULARY) -> bytes:
    """The rank file, read once on the driver; under a megabyte, so it goes to
    the tasks by value and executors need no such file."""
    with open(path, "rb") as f:
        return f.read()


def encoding(vocabulary: bytes):
    """The tiktoken encoding of a rank file, built once per Python worker."""
    import tiktoken  # noqa: PLC0415
    key = hash(vocabulary)
    if key not in _ENCODINGS:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        _ENCODINGS[key] = tiktoken.Encoding("ranks", pat_str=SPLIT_PATTERN, mergeable_ranks=ranks,
                                            special_tokens={})
    return _ENCODINGS[key]


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, end exclusive, by start and kind."""
    spans = [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    spans += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[0], KINDS.index(s[2])))


def made_of_words(run: str, encode, max_ratio: float = MAX_RATIO) -> bool:
    """Whether a run is a name all of whose parts have more characters per token."""
    return bool(NAME.match(run)) and all(len(w) > max_ratio * len(encode(w)) for w in LETTERS.findall(run))


def random_spans(text: str, taken: list[tuple[int, int, str]], encode, max_ratio: float = MAX_RATIO,
                 ) -> list[tuple[int, int, str]]:
    """Runs with few characters per token that touch no span of ``taken``."""
    found = []
    for m in RUN.finditer(text):
        run, (a, b) = m.group(), m.span()
        if KNOWN.match(run) or any(s < b and a < e for s, e, _ in taken):
            continue
        if len(run) <= max_ratio * len(encode(run)) and not made_of_words(run, encode, max_ratio):
            found.append((a, b, "random"))
    return found


def secret_spans(text: Column, vocabulary: bytes, max_ratio: float = MAX_RATIO) -> Column:
    """array<struct<kind, start, end>> by start, then kind; code points, end exclusive."""
    @F.pandas_udf("array<struct<kind:string,start:int,end:int>>")
    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = encoding(vocabulary).encode_ordinary
        for texts in batches:
            out = []
            for t in texts:
                base = base_spans(t or "")
                spans = sorted(base + random_spans(t or "", base, encode, max_ratio),
                               key=lambda s: (s[0], KINDS.index(s[2])))
                out.append([{"kind": k, "start": a, "end": b} for a, b, k in spans])
            yield pd.Series(out, dtype="object")
    return scan(text)


def find_secrets(docs: DataFrame, text: str = "text", vocabulary_path: str = VOCABULARY,
                 max_ratio: float = MAX_RATIO, out: str = "secrets") -> DataFrame:
    """``docs`` with ``out``: the secrets of the whole text. A projection: no
    shuffle. Null and empty texts have none; a column named ``out`` is replaced;
    equal rows have equal results."""
    ship(docs)
    return docs.withColumn(out, secret_spans(F.col(text), read_vocabulary(vocabulary_path), max_ratio))


def joined(spans: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
