"""Secret scans by dictionary-primed zstandard novelty.

Three base patterns are reported wherever they match. Beyond them, every long
token that follows a sensitive word closely is a candidate. zstandard is primed
with a dictionary of common identifiers and the code around the candidate (the
candidate cut out); the bytes that the candidate still adds, divided by its
length, are its novelty. Identifiers and words repeat the dictionary and cost
little; keys are incompressible, cost about a byte a character, and are reported
as ``novel``.

One pass, a row at a time, no shuffle; a task holds one Arrow batch.

Edge cases: null and empty texts have no spans; ids may be null or repeat, each
row keeps its own result; extra columns are not read by :func:`scan_secrets` and
pass through :func:`redact_secrets`; very long texts are scanned whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalendria.llm.support import lean

KINDS = ("assign", "access", "hex", "novel")

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_LONG = re.compile(r"[0-9a-f]{32,}")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 8, 16, 32

# Words that make what follows sensitive.
SENSITIVE = "password passwd passphrase pwd secret token api_key apikey api-key credential bearer authorization private_key access_key client_id signature session".split()

# The identifier dictionary that primes the compressor.
IDENTIFIERS = (
    "import from return class function const static public private void string int bool true false null None self this "
    "config settings environment variable default value example placeholder changeme your_password_here your_token_here "
    "username user_name password passwd secret token access_token refresh_token client_secret client_id api_key apikey "
    "authorization bearer basic header request response session cookie credential credentials certificate private_key "
    "public_key access_key secret_key key_id signature encrypt decrypt encode decode base64 hash sha256 digest localhost "
    "example.com http:// https:// www. .com .org .net .json .yaml .config get_ set_ is_ has_ _id _name _key _value _type "
    "0123456789 0000000000 1234567890 abcdefghijklmnopqrstuvwxyz ABCDEFGHIJKLMNOPQRSTUVWXYZ AAAAAAAA xxxxxxxx XXXXXXXX"
).encode()

CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
BEGIN, RUN = re.compile(r"[A-Za-z0-9+/_=-]"), re.compile(r"[A-Za-z0-9+/_=-]+")
#: A word of a name without digits, and the characters for each from which such a candidate is a name and not priced.
WORD, PER_WORD = re.compile("[A-Z]+(?![a-z])|[A-Z]?[a-z]+"), 3.5
#: Characters from which zstandard codes literals by their frequency.
CODED = 64
SENSITIVE_RE = re.compile("|".join(map(re.escape, SENSITIVE)), re.IGNORECASE | re.ASCII)
#: Code points after a sensitive word in which a candidate may begin.
REACH = 48
#: Code points of surrounding text on either side that prime the compressor.
AROUND = 256
#: Added bytes from which a candidate is reported, as a share of what its characters cost at least without any repeat.
NOVELTY = 0.75


class Novelty:
    """Marginal compressed bytes of a string against its surroundings and the identifier dictionary."""

    def __init__(self, identifiers: bytes = IDENTIFIERS):
        self.identifiers = identifiers
        self.params = zstandard.ZstdCompressionParameters.from_level(3, write_content_size=0, write_checksum=0, write_dict_id=0)

    def marginal(self, text: str, start: int, end: int) -> int:
        around = text[max(0, start - AROUND) : start] + "\n" + text[end : end + AROUND]
        primed = zstandard.ZstdCompressionDict(self.identifiers + around.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        pack = zstandard.ZstdCompressor(dict_data=primed, compression_params=self.params).compress
        return max(0, len(pack(text[start:end].encode())) - len(pack(b"")))


def wordy(token: str) -> bool:
    """Letters that fall into words where case or a sign changes: as names do, and unlike keys, whose runs are shorter."""
    if any(c.isdigit() for c in token):
        return False
    words = WORD.findall(token)
    return len(token) >= PER_WORD * len(words) if words else True


def least_bytes(token: str) -> float:
    """Bytes of a token that repeats nothing: one a character, or the entropy of its own characters where they are coded."""
    n = len(token)
    if n < CODED:
        return n
    return sum(k * math.log2(n / k) for k in Counter(token).values()) / 8


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the three base patterns, leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if "passw" in low or "secret" in low or "token" in low or "apikey" in low or "api_key" in low:
        found += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m.group(2)) >= MIN_ASSIGN]
    if "AKIA" in text:
        found += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if m.end() - m.start() >= MIN_ACCESS]
    # runs of the class are maximal, so asking for the length in the pattern finds the same runs
    found += [(m.start(), m.end(), "hex") for m in HEX_LONG.finditer(text)]
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def novel_spans(text: str, known: list[tuple[int, int, str]], meter: Novelty, threshold: float = NOVELTY) -> list[tuple[int, int, str, int]]:
    """Candidates in sensitive context, apart from known spans, that the primed compressor can't shorten."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    out, last = [], -1
    for word in SENSITIVE_RE.finditer(text):
        at = word.end()
        # a candidate begins within REACH and ends where its run ends
        while (m := BEGIN.search(text, max(at, last), at + REACH)) is not None:
            if (whole := CANDIDATE.match(text, m.start())) is None:
                last = RUN.match(text, m.start()).end()
                continue
            start, end = whole.span()
            last = end
            token = text[start:end]
            if not wordy(token) and not any(start < e and s < end for s, e, *_ in known):
                cost = meter.marginal(text, start, end)
                if cost >= threshold * least_bytes(token):
                    out.append((start, end, "novel", cost))
    return out


def spans_of(text: str | None, meter: Novelty, threshold: float = NOVELTY) -> list[tuple[int, int, str, int]]:
    """(start, end, kind, marginal bytes), sorted by start and then kind."""
    if not text:
        return []
    base = base_spans(text)
    spans = [(s, e, k, meter.marginal(text, s, e)) for s, e, k in base]
    return sorted(spans + novel_spans(text, base, meter, threshold), key=lambda s: (s[0], KINDS.index(s[2])))


SPAN = "array<struct<kind:string,start:int,end:int,marginal:int,secret:string>>"
_ARROW_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("marginal", pa.int32()), ("secret", pa.string())]))


def scan_secrets(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", threshold: float = NOVELTY) -> DataFrame:
    """(doc_id, spans) for each row of ``docs``; a span has kind, start, end (code points), marginal bytes and the string."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Novelty()
        for b in batches:
            spans = [[{"kind": k, "start": s, "end": e, "marginal": c, "secret": t[s:e]} for s, e, k, c in spans_of(t, meter, threshold)] for t in (x.as_py() for x in b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(spans, _ARROW_SPAN)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, spans {SPAN}")


def redacted(text: str, spans: list[tuple[int, int, str, int]], mark: str = "[secret]") -> str:
    """``text`` with each covered stretch replaced by ``mark``."""
    out, at, until = [], 0, -1
    for s, e, *_ in spans:
        if s >= until:
            out += [text[at:s] if s > at else "", mark]
        until = max(until, e)
        at = until
    return "".join(out) + text[at:]


def redact_secrets(docs: DataFrame, text_col: str = "text", threshold: float = NOVELTY, mark: str = "[secret]") -> DataFrame:
    """``docs`` with all its columns and rows, secrets in the text replaced by ``mark``."""
    at = docs.columns.index(text_col)

    def redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Novelty()
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [t if not (t and (s := spans_of(t, meter, threshold))) else redacted(t, s, mark) for t in texts]
            yield b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))

    return docs.mapInArrow(lean(redact), docs.schema)
