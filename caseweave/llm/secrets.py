"""Secret scans: fixed patterns, and a token-efficiency test that exposes random strings."""

from __future__ import annotations

import hashlib
import re

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import bpe_encoder, documents, send_code

KINDS = ("assign", "access", "hex", "random")
# The base patterns
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

# Candidates of the token test: long unbroken runs of the characters that encoded keys are made of
RUN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{16,}(?![A-Za-z0-9+/_=-])")
MAX_RATIO = 2.2  # characters per token: prose has 3 to 5, random letters and digits 1.2 to 1.9

# Known digests and identifiers, which are as random but no secrets
UUID = re.compile(r"[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128}|[0-9A-F]{32}|[0-9A-F]{40}|[0-9A-F]{64})")
DIGEST_NAME = r"(?:md5|sha-?\d{1,3}|blake[\w-]{0,3}|crc\d{0,3}|checksum|digest|etag|integrity|commit|rev|hash)"
NAMED = re.compile(r"(?<![A-Za-z0-9])" + DIGEST_NAME + "$", re.I | re.A)  # the end of what stands before the sign
NAMED_RUN = re.compile(DIGEST_NAME + "[-=]", re.I | re.A)  # name and sign are characters of the run
LONGEST_NAME = 9  # of a digest, and one character before it
NUMBERS = re.compile(r"[0-9TZ+/_=-]+")  # dates and times, telephone, card and order numbers, rules
ONE_CASE = r"(?:[A-Za-z][a-z]{0,30}|[A-Z]{1,31})"  # a word as prose has it: no digit, no capital inside, no longer than compounds get
WORDS = re.compile(f"[+/_=-]*{ONE_CASE}(?:[+/_=-]+{ONE_CASE})*[+/_=-]*")
ROOTED = re.compile(r"/[a-z]+/")  # a path from the root begins with the run
PORT = re.compile(r"\d{1,5}/")  # after a host and a colon
QUERY = re.compile(r"[A-Za-z_-][\w-]*=", re.A)  # the name before a value in an address


def begin(text: str, end: int, inside, least: int = 0) -> int:
    """Where the unbroken run of characters for which `inside` holds, up to `end`, begins (`least` at the earliest)."""
    while end > least and inside(text[end - 1]):
        end -= 1
    return end


def in_path(c: str) -> bool:
    return c.isalnum() or c in "_./~%@+$-"


def in_host(c: str) -> bool:
    return c.isalnum() or c in "_.-"


def in_user(c: str) -> bool:
    return not (c.isspace() or c in "/@")


def blank(c: str) -> bool:
    return c == " "


class Paths:
    """Whether a place goes on a path or address: a slash or `www.` stands in the unbroken path characters before it. Places are
    asked from left to right; of one path only what follows the place before is read, so a text is read once at most."""

    def __init__(self, text: str):
        self.text, self.seen, self.first, self.open = text, 0, 0, False

    def goes_on(self, place: int) -> bool:
        at = begin(self.text, place, in_path, self.seen)
        if at > self.seen or not self.seen:
            self.first, self.open = at, False
        part = self.text[max(self.first, at - 3):place]
        self.open, self.seen = self.open or "/" in part or "www." in part.lower(), place
        return self.open


def is_named(text: str, start: int) -> bool:
    """A digest's name and one of : = - stand before `start`, with blanks and quotation marks between."""
    at = begin(text, start - (text[start - 1:start] in ("'", '"')), blank)
    if text[at - 1:at] not in (":", "=", "-") or not at:
        return False
    at = begin(text, at - 1, blank)
    at -= text[at - 1:at] in ("'", '"')
    return bool(NAMED.search(text[max(0, at - LONGEST_NAME):at]))


def is_user(text: str, end: int) -> bool:
    """What ends at `end` is the user and password of an address."""
    at = begin(text, end, in_user)
    return text[at - 3:at] == "://" and text[at - 4:at - 3].isalnum()


def is_port(text: str, start: int) -> bool:
    """A port and the path after it begin at `start`."""
    if text[start - 1:start] != ":" or not PORT.match(text, start):
        return False
    at = begin(text, start - 1, in_host)
    return text[at - 3:at] == "://"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns; kind is the place in KINDS."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(spans)


def random_spans(text: str, taken: list[tuple[int, int, int]], encoder, max_ratio: float = MAX_RATIO) -> list[tuple[int, int, int]]:
    """Runs outside `taken` whose characters per token fall to `max_ratio`, without known digests and identifiers."""
    spans, paths = [], Paths(text)
    for m in RUN.finditer(text):
        run, start, end = m.group(), m.start(), m.end()
        if text[max(0, start - 1):start] in ("?", "&", "#") and (name := QUERY.match(run)):
            run, start = run[name.end():], start + name.end()
            if len(run) < 16:
                continue
        if any(s < end and start < e for s, _, e in taken) or WORDS.fullmatch(run) or NUMBERS.fullmatch(run) or UUID.fullmatch(run) or DIGEST.fullmatch(run):
            continue
        if len(run) / len(encoder.encode_ordinary(run)) > max_ratio:
            continue
        if text[end:end + 1] == "@" and not is_user(text, end):
            continue
        if NAMED_RUN.match(run) or ROOTED.match(run) or is_named(text, start) or paths.goes_on(start) or is_port(text, start):
            continue
        spans.append((start, 3, end))
    return spans


def find(text: str, encoder, max_ratio: float = MAX_RATIO) -> tuple[list, list]:
    base = base_spans(text)
    return base, sorted(base + random_spans(text, base, encoder, max_ratio))


def written(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


SCAN = "n_assign long, n_access long, n_hex long, n_random long, base_sha256 string, spans string"


def scan(docs: DataFrame, max_ratio: float = MAX_RATIO, ranks: str | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans for every row of `docs`.

    Spans are kind:start:end in code points over the whole match, end exclusive, by start, then kind. The token
    test looks at unbroken runs of 16 or more key characters; those outside the base spans that
    cost a byte-level BPE vocabulary one token per `max_ratio` characters or less count as random, unless they
    are words of one letter case (up to 31 letters, also joined by signs), digits only, a UUID, a bare digest, named as a digest, or a segment of a path themselves, however long that is. The value of a
    query in an address is tested without its name, the user and password of an address like other runs. Row by row: no shuffle.

    Null or empty text: no spans. Null doc_id: scanned, id null. Repeated rows are scanned each. Other columns
    are ignored.
    """
    @F.pandas_udf(SCAN)
    def look(texts: pd.Series) -> pd.DataFrame:
        encoder, rows = bpe_encoder(ranks), []
        for text in texts:
            base, spans = find(text, encoder, max_ratio)
            counts = [sum(k == kind for _, k, _ in spans) for kind in range(4)]
            rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans)))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in SCAN.split(", ")])

    return documents(docs).withColumn("_found", look("text")).select("doc_id", "_found.*")


def redact(docs: DataFrame, mark: str = "[SECRET]", max_ratio: float = MAX_RATIO, ranks: str | None = None) -> DataFrame:
    """`docs` with every found span replaced by `mark` (overlapping spans by one mark), and n_chars renewed where
    that column exists. Texts without a span, null ones too, and all other columns stay as they are."""
    send_code(docs.sparkSession)

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        encoder, out = bpe_encoder(ranks), []
        for text in texts:
            parts, end = [], 0
            for s, _, e in find(text, encoder, max_ratio)[1] if text else ():
                if s >= end:
                    parts += [text[end:s], mark]
                end = max(end, e)
            out.append("".join(parts) + text[end:] if text is not None else None)
        return pd.Series(out, dtype=object)

    changes = {"text": clean(F.col("text").cast("string"))}
    if "n_chars" in docs.columns:
        docs = docs.withColumn("_clean", changes["text"])
        changes = {"text": F.col("_clean"), "n_chars": F.when(F.col("_clean") != F.col("text"), F.char_length("_clean"))
                   .otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)}
    out = docs.withColumns(changes).drop("_clean")
    return out
