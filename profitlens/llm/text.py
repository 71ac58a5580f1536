"""Words, spans and Arrow passes shared by the text operators."""

from __future__ import annotations

import string
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LOWER = string.ascii_lowercase.encode()
_KEPT = string.digits.encode() + _LOWER + bytes(range(0x80, 0x100))
#: ASCII letters become lower case; every ASCII byte that is no letter or digit becomes a space.
WORD_TABLE = bytes(
    b | 0x20 if chr(b) in string.ascii_uppercase else b if b in _KEPT else 0x20 for b in range(256)
)


def words(data: bytes | None) -> list[bytes]:
    """Lower-cased runs of ASCII letters, digits and non-ASCII characters."""
    return data.translate(WORD_TABLE).split() if data else []


def word_starts(data: bytes) -> list[tuple[int, int]]:
    """Byte range of each of ``words(data)``."""
    spans, at = [], 0
    flat = data.translate(WORD_TABLE)
    for word in flat.split():
        at = flat.index(word, at)
        spans.append((at, at + len(word)))
        at += len(word)
    return spans


def code_points(data: bytes, end: int) -> int:
    """Number of characters in the first ``end`` bytes of UTF-8 data."""
    return len(data[:end].decode("utf-8", "ignore"))


def code_point_places(data: bytes, places: Iterable[int]) -> dict[int, int]:
    """For each byte position at the beginning of a character, the number of characters before it; one walk over the text."""
    found, at, count = {}, 0, 0
    for place in sorted(set(places)):
        count += len(data[at:place].decode("utf-8", "ignore"))
        at, found[place] = place, count
    return found


def merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open ranges, in order."""
    result: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if result and start <= result[-1][1]:
            result[-1] = (result[-1][0], max(end, result[-1][1]))
        else:
            result.append((start, end))
    return result


def cut(data: bytes, spans: Iterable[tuple[int, int]], marker: bytes = b"") -> bytes:
    """``data`` with each byte range replaced by the marker."""
    parts, at = [], 0
    for start, end in merged(spans):
        parts += [data[at:start], marker]
        at = end
    return b"".join([*parts, data[at:]])


def extended(schema: T.StructType, added: T.StructType) -> T.StructType:
    """``schema`` with the added fields last; they replace fields of the same name, in any case."""
    new = {f.name.lower() for f in added}
    return T.StructType([f for f in schema if f.name.lower() not in new] + list(added))


def columns_of(df: DataFrame) -> list[Column]:
    """All columns, whatever characters their names hold."""
    return [F.col(f"`{c}`") for c in df.columns]


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """A batch in small parts, so that what is computed for a part can go before the next one."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def add_columns(
    df: DataFrame,
    text: str,
    compute: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    added: T.StructType,
    keep: Iterable[str] | None = None,
) -> DataFrame:
    """One Arrow pass that appends columns computed from whole texts.

    ``compute`` is called once per task and returns a function from the texts
    of a small batch, in UTF-8, to one array per added field. ``keep`` names the
    columns returned beside them (all by default), so that texts that nobody
    needs later are not sent back.
    """
    kept = [f for f in df.schema if keep is None or f.name in set(keep)]
    schema = extended(T.StructType(kept), added)
    wanted = [f.name for f in schema][: len(schema) - len(added)]
    # numbered, as names with dots cannot enter an Arrow pass
    shown = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(wanted)]
    source = df.select(*shown, F.col(f"`{text}`").cast("binary").alias("utf8"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = compute()
        for batch in (part for whole in batches for part in slices(whole)):
            arrays = function(batch.column(len(wanted)).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(wanted))] + arrays, [f.name for f in schema])

    return source.mapInArrow(run, schema)
