"""Scan for secrets: fixed patterns, and strings of high entropy per character class.

Candidates are long runs of key characters. Over each run of one character class a window slides; its Shannon entropy
follows from character counts that change by one in and one out per step. Windows at or above the class's threshold are
joined to spans. A candidate is cut at its slashes into segments, and windows that lie wholly in segments on the allow list
are left out; spans of the fixed patterns always stay.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import map_batches, rows_in, small_batches

# Kinds and patterns of the base spans, in the order in which equal starts are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
ASSIGN_LEAST, ACCESS_LEAST = 12, 18
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """Runs of ``pattern`` are scanned; a window also needs letters and digits, as words and numbers are no keys."""

    name: str
    pattern: re.Pattern[str]
    bits: float


CLASSES = (
    CharacterClass("hex", re.compile(r"[0-9A-Fa-f]{20,}"), 3.0),
    CharacterClass("alphanumeric", re.compile(r"[0-9A-Za-z]{20,}"), 3.7),
    CharacterClass("base64", re.compile(r"[0-9A-Za-z+/_=-]{20,}"), 4.0),
)
#: A path; only its segments that are names are known not to be secrets.
PATH = r"^(?:[A-Za-z0-9_-]*/){3,}"
#: Segments that hold one of these are known not to be secrets.
ALLOWED = (
    r"(?i)example|sample|placeholder|dummy|changeme|your[_-]",
    r"(?i)0123456789|abcdefghij|deadbeef|(.)\1{7}",
    r"(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$",
    PATH,
)
#: Words in one case or in camel case with a short number, numbers with a short unit, and what dashes make of them.
_WORD = r"(?:[a-z]+|[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+)+|[A-Z][a-z]+)[0-9]{0,4}|[0-9]+[a-z]{0,3}"
NAME = re.compile(rf"[_-]*(?:(?:{_WORD})(?:[_-]+(?:{_WORD}))*[_-]*)?")
_TERM = [0.0] + [c * math.log2(c) for c in range(1, WINDOW + 1)]
_MIXED = re.compile(r"(?=.*[0-9])(?=.*[A-Za-z])")


def entropy_windows(text: str, bits: float, known: bytes | None = None) -> Iterator[tuple[int, int]]:
    """Joined windows of ``text`` with letters and digits whose Shannon entropy is at least ``bits``, without those whose
    characters are all ``known``.

    The entropy of a window of w characters is log2(w) - sum(c * log2(c)) / w over its character counts c.
    """
    counts: dict[str, int] = {}
    total, digits, letters = 0.0, 0, 0
    start = end = unknown = -1
    most = (math.log2(WINDOW) - bits) * WINDOW + 1e-9
    for at, char in enumerate(text):
        count = counts.get(char, 0)
        total += _TERM[count + 1] - _TERM[count]
        counts[char] = count + 1
        digits += char.isdigit()
        letters += char.isalpha()
        if known is None or not known[at]:
            unknown = at
        if at >= WINDOW:
            old = text[at - WINDOW]
            count = counts[old]
            total += _TERM[count - 1] - _TERM[count]
            counts[old] = count - 1
            digits -= old.isdigit()
            letters -= old.isalpha()
        if at >= WINDOW - 1 and total <= most and digits > 1 and letters > 1 and unknown > at - WINDOW:
            if start >= 0 and at - WINDOW + 1 > end:
                yield start, end
                start = -1
            if start < 0:
                start = at - WINDOW + 1
            end = at + 1
    if start >= 0:
        yield start, end


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans (start, number of the kind, end) of the fixed patterns, leftmost and non-overlapping per kind."""
    found = []
    lowered = text.lower()
    if any(word in lowered for word in ("passw", "secret", "token", "api")):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


@dataclass(frozen=True)
class AllowList:
    """The patterns but ``PATH`` in one, and whether ``PATH`` is among them."""

    pattern: re.Pattern[str]
    paths: bool


def known_characters(value: str, allowed: AllowList) -> bytes | None:
    """One byte per character of a candidate, 1 where it is known to be no secret; ``None`` if none is.

    An allow-list match makes the segments known in which it lies, and shorter ones than a window next to them. In a path
    names are known. Slashes belong to no segment and are known.
    """
    matches = [m.span() for m in allowed.pattern.finditer(value)]
    segments = [m.span() for m in re.finditer(r"[^/]+", value)]
    names = allowed.paths and re.match(PATH, value) is not None
    if not matches and not names and len(segments) == 1:
        return None
    held = [
        any(x < max(end, start + 1) and start < y for start, end in matches) or allowed.pattern.search(value[x:y]) is not None
        for x, y in segments
    ]
    short = [y - x < WINDOW for x, y in segments]
    for order in (range(1, len(segments)), range(len(segments) - 2, -1, -1)):
        step = -1 if order.step > 0 else 1
        for i in order:
            held[i] = held[i] or short[i] and held[i + step]
    if names:
        held = [h or NAME.fullmatch(value[x:y]) is not None for h, (x, y) in zip(held, segments, strict=True)]
    if not any(held):
        return None
    known = bytearray(b"\1" * len(value))
    for h, (x, y) in zip(held, segments, strict=True):
        if not h:
            known[x:y] = bytes(y - x)
    return bytes(known)


def added_spans(text: str, base: list[tuple[int, int, int]], allowed: AllowList) -> list[tuple[int, int, int]]:
    """Entropy spans; overlapping ones of several classes are joined, and what base spans hold of them is cut out."""
    raw = []
    for candidate in CANDIDATE.finditer(text):
        value, at = candidate[0], candidate.start()
        if not _MIXED.match(value):
            continue
        known = known_characters(value, allowed)
        if known and 0 not in known:
            continue
        for kind in CLASSES:
            for run in kind.pattern.finditer(value):
                own = known and known[run.start():run.end()]
                raw += [(at + run.start() + x, at + run.start() + y) for x, y in entropy_windows(run[0], kind.bits, own)]
    joined: list[list[int]] = []
    for x, y in sorted(raw):
        if joined and x <= joined[-1][1]:
            joined[-1][1] = max(joined[-1][1], y)
        else:
            joined.append([x, y])
    rest = []
    for x, y in joined:
        for start, _, end in base:  # sorted by their starts
            if start < y and x < end:
                if x < start:
                    rest.append((x, 3, start))
                x = end
        if x < y:
            rest.append((x, 3, y))
    return rest


def scan(text: str | None, allowed: AllowList) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    base = base_spans(text or "")
    return base, added_spans(text or "", base, allowed)


def spelled(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def allow_list(patterns: tuple[str, ...] = ALLOWED) -> AllowList:
    flagged = [(p[4:], "i") if p.startswith("(?i)") else (p, "") for p in patterns if p != PATH]
    joined = []
    groups = 0
    for body, flag in flagged:  # each pattern keeps its own flag and group numbers
        own = re.compile(body).groups
        body = re.sub(r"\\(\d+)", lambda m, shift=groups: f"\\{int(m[1]) + shift}", body)
        joined.append(f"(?{flag}:{body})" if flag else f"(?:{body})")
        groups += own
    return AllowList(re.compile("|".join(joined) or r"(?!)"), PATH in patterns)


def find_secrets(docs: DataFrame, patterns: tuple[str, ...] = ALLOWED) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``; other columns are ignored) ``doc_id, n_assign, n_access, n_hex,
    base_sha256, spans, n_entropy``.

    Offsets count code points, ends are exclusive. A null text is scanned as an empty one. Rows are scanned one by one, so
    repeated rows give repeated results; an empty table gives none.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        allowed = allow_list(patterns)
        for batch in batches:
            rows = []
            for doc, text in rows_in(batch, "doc_id", "text"):
                base, added = scan(text, allowed)
                kinds = [kind for _, kind, _ in base]
                digest = hashlib.sha256(spelled(base).encode()).hexdigest()
                rows.append((doc, kinds.count(0), kinds.count(1), kinds.count(2), digest, spelled(sorted(base + added)), len(added)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
            names = ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_entropy"]
            yield pa.record_batch([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(
        rows, run,
        "doc_id bigint, n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string, n_entropy bigint")


def masked(text: str, allowed: AllowList, mask: str) -> str:
    """The text with each span, or run of overlapping spans, replaced by ``mask``."""
    base, added = scan(text, allowed)
    out, done, upto = [], 0, 0
    for start, _, end in sorted(base + added):
        if start >= upto:
            out += [text[done:start], mask]
        done = upto = max(upto, end)
    return "".join([*out, text[done:]])


def mask_secrets(docs: DataFrame, mask: str = "<secret>", patterns: tuple[str, ...] = ALLOWED) -> Column:
    """Column: the ``text`` of ``docs`` with all secrets masked; null stays null."""

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        allowed = allow_list(patterns)
        return texts.map(lambda text: masked(text, allowed, mask), na_action="ignore")

    small_batches(docs)
    return cleaned("text")
