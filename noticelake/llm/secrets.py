"""Secret scans: base patterns, and a token-efficiency test for random strings.

Random strings cost a byte-pair vocabulary many tokens: a run of credential
characters with fewer characters a token than ``lowest_ratio`` is a span of kind
``random``, unless it is a known digest or identifier (a hexadecimal digest of
MD5, SHA-1, SHA-2 length, a UUID, a URL's or mail address's part, digits alone)
or a base pattern already has it. A full stop or ``@`` ends a run, so the parts
of ``a.b.c`` are tested one by one; URLs are known by ``scheme://`` and
addresses by ``@domain.tld``.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Memo, kept_by_worker, pieces, slim, table

# The base patterns and the kinds in the order that breaks ties of start.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the maximal runs of [0-9a-f]+ with 24 or more
_DIGEST = re.compile(r"[0-9a-fA-F]+")
_DIGEST_LENGTHS = (32, 40, 56, 64, 96, 128)
_PLACE = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*://[A-Za-z0-9+/_=-]*[.@][A-Za-z0-9+/_=.@-]*|[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")


@dataclass(frozen=True)
class SecretSettings:
    """``vocabulary`` is a tiktoken rank file; None takes the public 50k one."""

    vocabulary: str | None = None
    shortest: int = 20
    lowest_ratio: float = 2.0

    def candidate(self) -> re.Pattern:
        return re.compile(rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{self.shortest},}}")


def _encoding(path: str | None):
    import public_tokenizers
    import tiktoken

    with open(path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


class SecretFinder:
    """Spans ``(kind, start, end)`` in code points, end exclusive, by start and then kind."""

    def __init__(self, settings: SecretSettings = SecretSettings()):
        self.settings, self.candidate = settings, settings.candidate()
        encoding = _encoding(settings.vocabulary)
        self.random = Memo(lambda s: self._lettered(s) and len(s) < settings.lowest_ratio * len(encoding.encode_ordinary(s)), 50_000)

    @staticmethod
    def _lettered(s: str) -> bool:
        """With a letter, and neither a digest nor an identifier of a known form."""
        if not any(c.isalpha() for c in s):
            return False
        return not (_UUID.fullmatch(s) or len(s) in _DIGEST_LENGTHS and _DIGEST.fullmatch(s))

    def base(self, text: str) -> list[tuple[str, int, int]]:
        out = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
        if "AKIA" in text:
            out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
        return sorted(out + [("hex", *m.span()) for m in HEX.finditer(text)], key=_order)

    def find(self, text: str | None) -> tuple[list, list]:
        """The base spans, and all spans."""
        if not text:
            return [], []
        base = self.base(text)
        more: list[tuple[str, int, int]] = []
        covered, places = _Stretches([(a, b) for _, a, b in base]), None
        for m in self.candidate.finditer(text):
            a, b = m.span()
            if self.random[m[0]] and not covered.touch(a, b):
                if places is None:
                    places = _Stretches([p.span() for p in _PLACE.finditer(text)] if "@" in text or "://" in text else [])
                if not places.touch(a, b):
                    more.append(("random", a, b))
        return base, sorted(base + more, key=_order)


class _Stretches:
    """Intervals put together, asked about others that come in order of their starts: both are walked once."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.at, self.all = 0, []
        for a, b in sorted(spans):
            if self.all and a <= self.all[-1][1]:
                self.all[-1] = (self.all[-1][0], max(b, self.all[-1][1]))
            else:
                self.all.append((a, b))

    def touch(self, a: int, b: int) -> bool:
        while self.at < len(self.all) and self.all[self.at][1] <= a:
            self.at += 1
        return self.at < len(self.all) and self.all[self.at][0] < b


@kept_by_worker(2)
def secret_finder(settings: SecretSettings) -> SecretFinder:
    """One for each worker: the vocabulary is read once."""
    return SecretFinder(settings)


def _order(span: tuple[str, int, int]) -> tuple[int, int]:
    return span[1], KINDS.index(span[0])


def as_text(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def masked(text: str, spans: list[tuple[str, int, int]], mask: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced once."""
    out, at = [], 0
    for _, a, b in spans:
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


_OUT = pa.schema([("doc_id", pa.int64()), ("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string()), ("n_random", pa.int64())])


def find_secrets(docs: DataFrame, settings: SecretSettings = SecretSettings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of base spans by kind, their digest, and all spans, for every row; null is as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = secret_finder(settings)
        for batch in pieces(batches):
            cols: dict[str, list] = {f.name: [] for f in _OUT}
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                base, spans = finder.find(text)
                kinds = [k for k, _, _ in spans]
                row = (doc, *(kinds.count(k) for k in KINDS[:3]), hashlib.sha256(as_text(base).encode()).hexdigest(), as_text(spans), kinds.count("random"))
                for f, value in zip(_OUT, row, strict=True):
                    cols[f.name].append(value)
            yield pa.RecordBatch.from_pydict(cols, schema=_OUT)

    return slim(docs, id_col, text_col).select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long")


def mask_secrets(docs: DataFrame, settings: SecretSettings = SecretSettings(), text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All rows and columns of ``docs``, the secrets of its texts masked; null texts stay null."""
    names = docs.columns
    at = names.index(text_col)
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = secret_finder(settings)
        for batch in pieces(batches):
            texts = [t if t is None else masked(t, finder.find(t)[1]) for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(texts, batch.schema.field(k).type) if k == at else batch.column(k) for k in range(batch.num_columns)], schema=batch.schema)

    out = docs.mapInArrow(run, schema)
    return out.withColumn(length_col, F.length(text_col).cast(schema[length_col].dataType)) if length_col in names else out


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans (and n_random) for every document."""
    return find_secrets(table(spark, sf_dir, "documents"))
