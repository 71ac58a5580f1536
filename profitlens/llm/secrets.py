"""Secret scans: keywords first, regular expressions only beside them, checksums last.

An Aho-Corasick automaton finds all keywords in one pass over the lower-cased
text. A kind's expression is tried only where one of its keywords stands,
anchored there. Long hexadecimal runs have no keyword; a run of 32 or more
covers a multiple of 32, so every 32nd byte is looked at and the run around it
is measured. Tokens with an embedded checksum (CRC-32 in GitHub and npm tokens,
Luhn digits of cards, mod 97 of IBANs, the JSON header of a JWT) count only if
it holds.

A private key is one span from its BEGIN line over the body to its END line, or
to the last base64 line where the END line is missing.

Matches of a kind are leftmost and do not overlap; a match that is too short or
fails its checksum is dropped after it has taken its place.

Edge cases: null is an empty text; both have no span; repeated rows are scanned
one by one; positions count code points, ends are exclusive; result columns
replace columns of the same name.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from zlib import crc32

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm.text import add_columns, code_point_places, cut, slices

BASE62 = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
LONG_RUN = 32
#: From BEGIN to the END line, whatever stands between. Without END: header lines, then lines that are base64 as a whole and
#: long base64 words. Line ends may be written as backslash n. Possessive, so that no text is gone through twice.
PRIVATE_KEY = re.compile(
    rb"""-----BEGIN\x20(?:[A-Z0-9]+\x20)*PRIVATE\x20KEY(?:\x20BLOCK)?-----
    (?: (?:(?!-----).)*+ -----END\x20(?:[A-Z0-9]+\x20)*PRIVATE\x20KEY(?:\x20BLOCK)?-----
      | (?: (?:\s|\\[nr])++ [A-Za-z][A-Za-z0-9-]*+:[^\n\\]*+ )*+
        (?: (?:\s|\\[nr])++ [A-Za-z0-9+/=]{16,}+
          | (?:[ \t]*+(?:\r?\n|(?:\\r)?\\n))++ [ \t]*+ [A-Za-z0-9+/=]++ (?=[ \t]*(?:[\r\n]|\\[nr]|\Z)) )*+
    )""",
    re.DOTALL | re.VERBOSE,
)


def crc_token(match: re.Match) -> bool:
    """The last six characters are the CRC-32 of the thirty before them, in base 62."""
    body, check = match[1][:-6], match[1][-6:]
    value, digits = crc32(body), b""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit : digit + 1] + digits
    return digits == check


def luhn(match: re.Match) -> bool:
    """Card digits whose Luhn sum ends in zero."""
    digits = [c - 48 for c in reversed(match[1]) if 48 <= c <= 57]
    doubled = [sum(divmod(2 * d, 10)) if i % 2 else d for i, d in enumerate(digits)]
    return 13 <= len(digits) <= 19 and sum(doubled) % 10 == 0


def mod97(match: re.Match) -> bool:
    """An IBAN moved by four places leaves 1 modulo 97."""
    account = match[1].replace(b" ", b"").decode()
    return 15 <= len(account) <= 34 and int("".join(str(int(c, 36)) for c in account[4:] + account[:4])) % 97 == 1


def json_header(match: re.Match) -> bool:
    """The first part of a JWT is a JSON object that names an algorithm."""
    part = match[0].split(b".")[0]
    try:
        return "alg" in json.loads(base64.urlsafe_b64decode(part + b"=" * (-len(part) % 4)))
    except (binascii.Error, ValueError, TypeError):
        return False


@dataclass(frozen=True)
class Kind:
    """``valid`` judges a match of ``pattern``, which is tried where a keyword begins."""

    name: str
    keywords: tuple[str, ...]
    pattern: re.Pattern
    valid: Callable[[re.Match], bool]


# The base kinds, in the order in which equal starts are listed, then the added ones.
KINDS = (
    Kind(
        "assign",
        ("password", "passwd", "secret", "token", "apikey", "api_key"),
        re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE),
        lambda m: len(m[2]) >= 8,
    ),
    Kind("access", ("akia",), re.compile(rb"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 16),
    Kind("hex", (), re.compile(rb"[0-9a-f]+"), lambda m: len(m[0]) >= LONG_RUN),
    Kind("github", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), crc_token),
    Kind("npm", ("npm_",), re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), crc_token),
    Kind("jwt", ("eyj",), re.compile(rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+"), json_header),
    Kind("pem", ("-----begin ",), PRIVATE_KEY, lambda m: True),
    Kind("card", ("card",), re.compile(rb"card[^0-9\n]{0,24}([0-9](?:[ -]?[0-9]){12,18})(?![0-9])", re.IGNORECASE), luhn),
    Kind("iban", ("iban",), re.compile(rb"iban[: ]{0,3}([A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30})(?![A-Z0-9])", re.IGNORECASE), mod97),
)
BASE_KINDS = ("assign", "access", "hex")
ORDER = {kind.name: i for i, kind in enumerate(KINDS)}


def automaton() -> ahocorasick.Automaton:
    """Keyword -> its length and the kinds it announces."""
    kinds: dict[str, list[int]] = {}
    for number, kind in enumerate(KINDS):
        for keyword in kind.keywords:
            kinds.setdefault(keyword, []).append(number)
    words = ahocorasick.Automaton()
    for keyword, numbers in kinds.items():
        words.add_word(keyword, (len(keyword), numbers))
    words.make_automaton()
    return words


def long_runs(data: bytes) -> Iterator[tuple[int, int]]:
    """Maximal runs of 32 or more lower-case hexadecimal digits."""
    run = KINDS[ORDER["hex"]].pattern
    done = 0
    for probe in run.finditer(data[LONG_RUN - 1 :: LONG_RUN]):
        for step in range(probe.start(), probe.end()):
            at = LONG_RUN - 1 + step * LONG_RUN
            if at < done:
                continue
            start = at
            while start > done and data[start - 1] in b"0123456789abcdef":
                start -= 1
            done = run.match(data, start).end()
            if done - start >= LONG_RUN:
                yield start, done


def scan(data: bytes | None, keywords: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of every secret, by byte position, then kind."""
    if not data:
        return []
    spans: list[tuple[int, int, int]] = []
    done = dict.fromkeys(range(len(KINDS)), 0)
    # one character per byte, so that positions are byte positions; only ASCII letters change case
    hits = [(end + 1 - length, kinds) for end, (length, kinds) in keywords.iter(data.lower().decode("latin-1"))]
    for start, kinds in sorted(hits, key=lambda h: h[0]):
        for number in kinds:
            if start < done[number]:
                continue
            match = KINDS[number].pattern.match(data, start)
            if match:
                done[number] = match.end()
                if KINDS[number].valid(match):
                    spans.append((start, number, match.end()))
    spans += [(start, ORDER["hex"], end) for start, end in long_runs(data)]
    return sorted(spans)


RESULT = T.StructType([
    T.StructField("secret_spans", T.ArrayType(T.StructType([
        T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    ]))),
])


def find_secrets(docs: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """``docs`` with secret_spans: kind, start and end of each secret by start, then kind."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def scanner():
        keywords = automaton()

        def named(data: bytes | None) -> list[dict]:
            spans = scan(data, keywords)
            at = code_point_places(data or b"", (place for start, _, end in spans for place in (start, end)))
            return [{"kind": KINDS[k].name, "start": at[start], "end": at[end]} for start, k, end in spans]

        return lambda texts: [pa.array([named(t) for t in texts], kind)]

    return add_columns(docs, text, scanner, RESULT, keep)


def redact(docs: DataFrame, text: str = "text", size: str | None = "n_chars", marker: str = "[secret]") -> DataFrame:
    """``docs`` with every secret replaced by the marker; ``size`` names the column that counts characters."""
    schema, counts = docs.schema, size in docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keywords = automaton()
        for batch in (part for whole in batches for part in slices(whole)):
            columns = {f.name: batch.column(i) for i, f in enumerate(schema)}
            texts = columns[text].to_pylist()
            sizes = columns[size].to_pylist() if counts else []
            for i, value in enumerate(texts):
                data = value.encode() if value else None
                spans = scan(data, keywords)
                if spans:
                    texts[i] = cut(data, [(a, b) for a, _, b in spans], marker.encode()).decode()
                    if counts:
                        sizes[i] = len(texts[i])
            columns[text] = pa.array(texts, columns[text].type)
            if counts:
                columns[size] = pa.array(sizes, columns[size].type)
            yield pa.RecordBatch.from_arrays([columns[f.name] for f in schema], [f.name for f in schema])

    # numbered, as names with dots cannot enter an Arrow pass
    return docs.toDF(*[f"c{i}" for i in range(len(schema))]).mapInArrow(run, schema)


def spans_text(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
