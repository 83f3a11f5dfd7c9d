"""Secret scans: known forms of secrets, and strings whose entropy gives them away.

Three base kinds are found by their form: assignments to names such as "password", access
keys and long hex strings.  The fourth kind, "entropy", slides a window over each long run
of key-like characters, and over each long part between its separators, and measures the
Shannon entropy of each window, from counts that are updated by one character in and one
out.  The floor is that of the alphabet that the run or part is written in.  Runs that an
allow list explains are left alone, and so are names whose parts it explains, up to a higher
floor; of a run that holds an example only the part that says so is.  The base kinds are
never suppressed.  So keys without digits are found unless they read as words: letters of
one case only, or capitalised words joined as in CamelCase (about 1 in 1000 random keys of
20 letters of both cases).

Spans are in code points, end exclusive.  Defined results: a null text is empty and has no
spans; spans of one kind never overlap; repeated rows are scanned alike; an empty table
gives an empty result; other columns are ignored by `find_secrets` and kept by
`redact_secrets`.  Bytes that are not UTF-8 count as one replacement character each.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from guardwork.llm.worker_memory import at_work

# The base kinds in the order of the list, and their forms.
KINDS = ("assign", "access", "hex", "entropy")
_ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run is taken whole, so this is [0-9a-f]+ of 16 or more
_ASSIGN_LEAST, _ACCESS_LEAST = 12, 18

_CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
#: Texts without a match hold no span of any kind; only the others are looked at closely.
_ANY = (
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]{12,}"""
    r"""|[A-Za-z0-9+/_=-]{20,}|AKIA[A-Z0-9]{14,}|[0-9a-f]{16,}"""
)

WINDOW = 20
#: Alphabets in the order of trial: form, and the bits per character that a window must reach.
#: 1 in 1000 random windows of the alphabet (of 16, 32, 36, 52, 62 and 64 characters) lies
#: below.  Names joined in one case, or of words and numbers, are no alphabet of keys; they need
#: more than their words have.
LEAST_OF_NAMES = 3.8
ALPHABETS = tuple(
    (name, re.compile(form), least)
    for name, form, least in (
        ("hex", r"[0-9a-fA-F]+", 2.7),
        ("base32", r"[A-Z2-7]+|[a-z2-7]+", 3.14),
        ("base36", r"[A-Z0-9]+|[a-z0-9]+", 3.24),
        ("letters", r"[A-Za-z]+", 3.4),
        ("base62", r"[A-Za-z0-9]+", 3.48),
        ("joined", r"[^A-Z]+|[^a-z]+", LEAST_OF_NAMES),
        ("base64", r".+", 3.48),
    )
)
_SEPARATORS = re.compile(r"[-+/_=]+")
#: Parts that say themselves that they are no secrets; two well-known example keys hold separators.
EXAMPLES = re.compile(r"(?i)example|sample|dummy|placeholder|changeme|xxxx")
_PART = re.compile(
    r"wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY|je7MtGbClwBF/2Zp9Utk/h3yCo8nvbEXAMPLEKEY|[A-Za-z0-9]+"
)
#: Runs that are explained otherwise: digests of well-known files, paths, repeats.
ALLOWED = tuple(
    re.compile(form)
    for form in (
        r"^[0-9]+$",
        r"^[A-Z]?[a-z]+([-_/][A-Z]?[a-z]+)*$",
        r"^[A-Z]+([-_/][A-Z]+)*$",
        r"^[a-z]*([A-Z][a-z]{2,})+$",
        r"^(.{1,6})\1{2,}.{0,5}$",
        r"^[-=_+/]+$",
        r"(?i)^sha(1|256|384|512)-",
    )
)

Span = tuple[str, int, int]


def alphabet_of(run: str) -> tuple[str, float]:
    """Name and floor of the first alphabet that has all characters of the run."""
    return next((name, least) for name, form, least in ALPHABETS if form.fullmatch(run))


def highest_entropy(run: str, window: int = WINDOW) -> float:
    """The largest entropy of any window, in bits per character; each step costs two updates."""
    table = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total = best = 0.0  # total: the sum of n log n over the counts
    for i, char in enumerate(run):
        n = counts.get(char, 0)
        counts[char] = n + 1
        total += table[n + 1] - table[n]
        if i >= window:
            old = run[i - window]
            n = counts[old]
            counts[old] = n - 1
            total += table[n - 1] - table[n]
        if i >= window - 1:
            best = max(best, math.log2(window) - total / window)
    return best


def allowed(run: str) -> bool:
    return any(form.search(run) for form in ALLOWED)


def _random(run: str) -> bool:
    return len(run) >= WINDOW and not allowed(run) and highest_entropy(run) >= alphabet_of(run)[1]


def is_key(run: str) -> bool:
    """Whether the run, or a part of it, reaches the floor of its alphabet unexplained."""
    if allowed(run):
        return False
    # A key may be joined to a name by a separator, or hold separators itself.
    parts = [part for part in _SEPARATORS.split(run) if part]
    if any(map(_random, parts)):
        return True
    if all(map(allowed, parts)):  # words and numbers
        both = any(c.isdigit() for c in run) and any(c.isalpha() for c in run)
        return both and highest_entropy(run) >= LEAST_OF_NAMES
    return _random(run)


def between_examples(run: str) -> Iterator[tuple[int, int]]:
    """Start and end of what is long enough between the run's examples and their separators."""
    at = 0
    for part in _PART.finditer(run):
        if EXAMPLES.search(part.group()):
            if part.start() - 1 - at >= WINDOW:
                yield at, part.start() - 1
            at = part.end() + 1
    if len(run) - at >= WINDOW:
        yield at, len(run)


def entropy_spans(text: str) -> Iterator[Span]:
    for match in _CANDIDATE.finditer(text):
        run, start = match.group(), match.start()
        if not allowed(run):
            for a, b in between_examples(run):
                if is_key(run[a:b]):
                    yield "entropy", start + a, start + b


def base_spans(text: str) -> Iterator[Span]:
    for match in _ASSIGN.finditer(text):
        if len(match.group(2)) >= _ASSIGN_LEAST:
            yield "assign", match.start(), match.end()
    for match in _ACCESS.finditer(text):
        if match.end() - match.start() >= _ACCESS_LEAST:
            yield "access", match.start(), match.end()
    for match in _HEX.finditer(text):
        yield "hex", match.start(), match.end()


def spans_of(text: str) -> list[Span]:
    """All spans by start, then kind."""
    return sorted([*base_spans(text), *entropy_spans(text)], key=lambda s: (s[1], KINDS.index(s[0])))


def _suspects(column: pa.Array) -> Iterator[tuple[int, str]]:
    """Row number and text of the rows that may hold a span."""
    raw = column.cast(pa.binary())
    hits = pc.fill_null(pc.match_substring_regex(raw, _ANY), False)
    rows = pc.indices_nonzero(hits)
    for row, text in zip(rows.to_pylist(), raw.take(rows).to_pylist(), strict=True):
        yield row, text.decode("utf-8", "replace")


_SPAN_TYPE = T.ArrayType(
    T.StructType(
        [T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]
    )
)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id and spans, an array of (kind, start, end)."""
    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("spans", _SPAN_TYPE)]
    )
    arrow_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("secret_scan")
        for batch in batches:
            found: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            for row, text in _suspects(batch.column("text")):
                found[row] = [{"kind": k, "start": s, "end": e} for k, s, e in spans_of(text)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(found, arrow_type)], names=["doc_id", "spans"]
            )

    return docs.select("doc_id", "text").mapInArrow(scan, schema)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with each stretch of overlapping spans replaced by the name of its first kind."""
    out, at, end, kind = [], 0, -1, ""
    for k, start, stop in spans:
        if start < end:
            end = max(end, stop)
            continue
        if end >= 0:
            out.append(f"[{kind}]")
            at = end
        out.append(text[at:start])
        kind, end = k, stop
    if end >= 0:
        out.append(f"[{kind}]")
        at = end
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame) -> DataFrame:
    """The documents with their secrets replaced; n_chars, where there is one, follows the text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_work("secret_scan")
        for batch in batches:
            names = batch.schema.names
            at = names.index("text")
            changed = {row: redacted(text, spans) for row, text in _suspects(batch.column(at)) if (spans := spans_of(text))}
            if changed:
                columns = list(batch.columns)
                columns[at] = _replaced(columns[at], changed)
                if "n_chars" in names:
                    n = names.index("n_chars")
                    columns[n] = _replaced(columns[n], {row: len(text) for row, text in changed.items()})
                batch = pa.RecordBatch.from_arrays(columns, schema=batch.schema)
            yield batch

    return docs.mapInArrow(scan, docs.schema)


def _replaced(column: pa.Array, values: dict[int, object]) -> pa.Array:
    mask = [False] * len(column)
    for row in values:
        mask[row] = True
    return pc.replace_with_mask(column, pa.array(mask), pa.array([values[r] for r in sorted(values)], column.type))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def digest(spans: list[Span]) -> str:
    return hashlib.sha256(joined(spans).encode()).hexdigest()


def secret_report(docs: DataFrame) -> DataFrame:
    """Counts, digest of the base spans and all spans as text, per document."""
    kind_count = lambda kind: F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long")
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ","
    )
    return find_secrets(docs).select(
        "doc_id",
        kind_count("assign").alias("n_assign"),
        kind_count("access").alias("n_access"),
        kind_count("hex").alias("n_hex"),
        kind_count("entropy").alias("n_entropy"),
        F.sha2(text(F.filter("spans", lambda s: s.kind != "entropy")), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
