"""Secret scans: fixed patterns, and a token-efficiency test for random strings.

Fixed patterns find assignments of passwords and keys (``assign``), access key ids (``access``) and long hexadecimal
strings (``hex``). Beyond them, every run of 16 or more key characters is a candidate: text-like strings take few tokens of a
byte-level vocabulary, random ones take many. A candidate below ``max_ratio`` characters per token (``WORDS_RATIO`` for words
of one case, alone or joined to identifiers, as rare words are cut small too) is a finding of kind ``random``, unless it
overlaps a fixed finding or is a known harmless form: a digest of usual length (md5, sha1, sha256, sha512), a UUID, a number,
or part of a whole e-mail address, host or file name all of whose parts are words with at most four digits. Parts of other
dotted strings (tokens of three parts), of pairs and of URLs (``user:password@host``) are candidates like any other run.

Offsets are code points, ends exclusive. Null and empty texts have no findings. Repeated rows are scanned as often as
they occur. Rows are independent, so any task can be run again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from vitrine.llm.common import per_worker, slices, tidy

KINDS = ("assign", "access", "hex", "random")

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(
    r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs of 32 or more
ASSIGN_VALUE, ACCESS_LENGTH = 8, 16

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
HARMLESS = re.compile(
    r"(?i:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{64}|[0-9a-f]{128}"
    r"|[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"
    r"|[0-9+/_=-]+"
)
WORDS = re.compile(
    r"(?:[A-Za-z]?[a-z]+|[A-Z]+|\d{1,4})(?:[_/-](?:[A-Za-z]?[a-z]+|[A-Z]+|\d{1,4}))*"
)
WORDS_RATIO = 1.8
ADDRESS_CHARS = re.compile(r"[A-Za-z0-9+/_=.@-]+")
ADDRESS = re.compile(  # a whole address, host or file name
    r"(?:[A-Za-z0-9+_=.-]+@)?[A-Za-z0-9+/_=-]+(?:\.[A-Za-z0-9+/_=-]+)+\.?"
)
SEPARATORS = re.compile(r"[+/_=.@-]+")
ADDRESS_PART = re.compile(r"(?:[A-Za-z]?[a-z]+|[A-Z]+)\d{0,4}|\d{1,4}|")
SHORT_PART = 8  # longer parts of addresses have to be text-like by tokens

PIECE = 4096  # characters of a run that are encoded at once

SPANS = "array<struct<kind:string,start:int,end:int>>"


def encoder(vocabulary: str, pattern: str):
    """The byte-level encoder of a rank file."""
    import tiktoken

    with open(vocabulary, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """``(start, end, kind)`` of the fixed patterns."""
    found = [
        (m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_VALUE
    ]
    found += [
        (m.start(), m.end(), "access")
        for m in ACCESS.finditer(text)
        if m.end() - m.start() >= ACCESS_LENGTH
    ]
    found += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    return found


def in_address(whole: str, encode, max_ratio: float) -> bool:
    """Whether a run of ``ADDRESS_CHARS`` is an e-mail address, host or file name that is made of text-like parts."""
    return ADDRESS.fullmatch(whole) is not None and all(
        ADDRESS_PART.fullmatch(part) and (len(part) < SHORT_PART or len(part) / tokens(part, encode) >= max_ratio)
        for part in SEPARATORS.split(whole)
    )


def tokens(run: str, encode) -> int:
    """The number of tokens of a run; a very long one is encoded in pieces."""
    return sum(len(encode(run[at : at + PIECE])) for at in range(0, len(run), PIECE))


def merged(spans: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """The places that spans cover, as disjoint runs in order."""
    runs: list[tuple[int, int]] = []
    for start, end, _ in sorted(spans):
        if runs and start <= runs[-1][1]:
            runs[-1] = runs[-1][0], max(end, runs[-1][1])
        else:
            runs.append((start, end))
    return runs


def random_spans(text: str, taken: list[tuple[int, int, str]], encode, max_ratio: float):
    """Candidates with few characters per token that overlap nothing in ``taken``.

    One pass: a run that may be an address is judged once for all candidates in it, and covered places are walked along.
    """
    covered, at = merged(taken), 0
    for around in ADDRESS_CHARS.finditer(text):
        verdicts: dict[float, bool] = {}
        for m in CANDIDATE.finditer(text, around.start(), around.end()):
            run, start, end = m[0], m.start(), m.end()
            while at < len(covered) and covered[at][1] <= start:
                at += 1
            if (at < len(covered) and covered[at][0] < end) or HARMLESS.fullmatch(run):
                continue
            least = min(WORDS_RATIO, max_ratio) if WORDS.fullmatch(run) else max_ratio
            if len(run) / tokens(run, encode) >= least:
                continue
            if len(run) < around.end() - around.start():
                if least not in verdicts:
                    verdicts[least] = in_address(around[0], encode, least)
                if verdicts[least]:
                    continue
            yield start, end, "random"


def scan_text(text: str | None, encode, max_ratio: float) -> list[dict]:
    if not text:
        return []
    found = base_spans(text)
    found += list(random_spans(text, found, encode, max_ratio))
    found.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return [{"kind": kind, "start": start, "end": end} for start, end, kind in found]


def find_secrets(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text_column: str = "text",
    max_ratio: float = 2.2,
) -> DataFrame:
    """``docs`` with ``secrets``: its findings, by start and then by kind."""

    @F.arrow_udf(SPANS)
    @tidy
    def scan(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = (vocabulary, pattern)
        encode = per_worker(("secrets", *key), lambda: encoder(*key)).encode_ordinary
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in texts:
            found = [pa.array([], kind)]
            for start, end in slices(batch):
                part = batch.slice(start, end - start)
                found.append(pa.array([scan_text(t.as_py(), encode, max_ratio) for t in part], kind))
            yield pa.concat_arrays(found)

    return docs.withColumn("secrets", scan(F.col(text_column)))


def mark_out(text: str | None, spans: list[dict], mark: str) -> str | None:
    """``text`` with ``mark`` for each span; overlapping spans, which come by start, share one mark."""
    if not spans:
        return text
    parts, end = [], 0
    for span in spans:
        if span["start"] >= end:
            parts += [text[end : span["start"]], mark]
        end = max(end, span["end"])
    return "".join(parts) + text[end:]


def redact(docs: DataFrame, text_column: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` that have ``secrets``, with every finding replaced by ``mark``; null text stays null."""

    @F.arrow_udf("string")
    def hide(texts: pa.Array, spans: pa.Array) -> pa.Array:
        pairs = zip(texts, spans, strict=True)
        return pa.array([mark_out(t.as_py(), s.as_py(), mark) for t, s in pairs], pa.string())

    found = F.size("secrets") > 0
    return docs.withColumn(
        text_column,
        F.when(found, hide(F.col(text_column), F.col("secrets"))).otherwise(F.col(text_column)),
    )


def hide_secrets(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text_column: str = "text",
    max_ratio: float = 2.2,
    mark: str = "[secret]",
) -> DataFrame:
    """``docs`` with every finding replaced by ``mark``, as ``redact`` after ``find_secrets``, by one Python worker a task."""

    @F.arrow_udf("string")
    @tidy
    def hide(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = (vocabulary, pattern)
        encode = per_worker(("secrets", *key), lambda: encoder(*key)).encode_ordinary
        for batch in texts:
            hidden = [pa.array([], pa.string())]
            for start, end in slices(batch):
                part = (t.as_py() for t in batch.slice(start, end - start))
                hidden.append(pa.array([mark_out(t, scan_text(t, encode, max_ratio), mark) for t in part], pa.string()))
            yield pa.concat_arrays(hidden)

    return docs.withColumn(text_column, hide(F.col(text_column)))
