"""Fill-in-middle: texts with their middle moved to the end, by rotations of blocks in place.

A text is scanned for the ends of its units (a word with the white space before it; white space at the text's
end is a unit of its own). Two of n + 1 cuts, drawn from a hash of seed and id, make prefix, middle and suffix. The three
sentinels are inserted into a bytearray before the blocks they mark, and blocks are exchanged by three reversals each:
``P M S`` becomes ``P S M`` (psm) by one rotation, and ``S P M`` (spm) by a second one. ``restore`` finds the sentinels
of an output, turns the same rotations back, last first, and deletes the sentinels, which gives the text exactly.

A text that is empty, holds a sentinel, or is drawn to be so stays plain. As no other text holds a sentinel, and a
sentinel's first sign occurs nowhere else in it, each is found at one place only.

Every row is handled by itself, in one pass; nothing is shuffled and a lost task is only run again.

Edge cases: a null text is the empty text, and so plain; a null id draws as the empty id; equal ids draw alike,
so repeated rows get the same output; a text is one value and may be as long as one (2 GB), its cuts are arrays of
its units; other columns are kept, and own columns get an underscore behind a name that is taken; an empty table
gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from placelens.llm import shared as s

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SEED = 42
PERCENT, SPM_PERCENT = 50, 80
COLUMNS = {"n": "long", "form": "string", "prefix_chars": "long", "middle_chars": "long", "output": "string"}


def cuts(text: bytes) -> np.ndarray:
    """Where each unit of the text ends, in bytes."""
    data = np.frombuffer(text, np.uint8)
    if not len(data):
        return np.zeros(0, np.int64)
    space = s._IS_SPACE[data]
    ends = ~space
    ends[:-1] &= space[1:]
    ends[-1] = True
    return np.flatnonzero(ends) + 1


def draws(seed: int, doc_id: object) -> tuple[int, int, int, int]:
    """Four numbers of 32 bits for a row."""
    key = f"{seed}:{'' if doc_id is None else doc_id}"
    digits = hashlib.sha256(key.encode()).hexdigest()
    return tuple(int(digits[i : i + 8], 16) for i in (0, 8, 16, 24))


def rotate(block: bytearray, first: int, middle: int, last: int) -> None:
    """Exchange block[first:middle] and block[middle:last] in place, by three reversals."""
    view = np.frombuffer(block, np.uint8)
    for a, b in ((first, middle), (middle, last), (first, last)):
        view[a:b] = view[a:b][::-1]


def rearrange(text: bytes, first: int, second: int, spm: bool) -> bytes:
    """The text with the part between the two byte offsets at the end."""
    block = bytearray(text)
    # From the back, so that earlier offsets still hold.
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        block[at:at] = sentinel
    middle, suffix = first + len(PREFIX), second + len(PREFIX) + len(MIDDLE)
    rotate(block, middle, suffix, len(block))
    if spm:
        rotate(block, 0, middle, middle + len(block) - suffix)
    return bytes(block)


def restored(output: bytes, form: str) -> bytes:
    """The text that an output of this form was made of."""
    if form == "plain":
        return output
    block = bytearray(output)
    prefix, suffix, middle = (block.index(x) for x in (PREFIX, SUFFIX, MIDDLE))
    if form == "spm":
        rotate(block, 0, prefix, middle)
        prefix, suffix = 0, middle - prefix
    held = middle - suffix  # the suffix and its sentinel
    rotate(block, suffix, middle, len(block))
    middle, suffix = suffix, len(block) - held
    for at, sentinel in ((suffix, SUFFIX), (middle, MIDDLE), (prefix, PREFIX)):
        del block[at : at + len(sentinel)]
    return bytes(block)


def _characters(text: bytes) -> int:
    data = np.frombuffer(text, np.uint8)
    return int(np.count_nonzero((data & 0xC0) != 0x80))


def _row(text: bytes, doc_id: object, seed: int, percent: int, spm_percent: int) -> tuple:
    ends = cuts(text)
    n = len(ends)
    h1, h2, h3, h4 = draws(seed, doc_id)
    if not text or h3 % 100 >= percent or any(x in text for x in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    offsets = np.r_[0, ends]
    first, second = sorted((int(offsets[h1 % (n + 1)]), int(offsets[h2 % (n + 1)])))
    spm = h4 % 100 < spm_percent
    chars = _characters(text[:first]), _characters(text[first:second])
    return n, "spm" if spm else "psm", *chars, rearrange(text, first, second, spm)


def _bytes(column: pa.Array) -> Iterator[bytes]:
    data, offsets = s.text_bytes(column)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        yield data[a:b].tobytes()


def _strings(values: list[bytes]) -> pa.Array:
    return pa.array(values, pa.binary()).cast(pa.string())


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = SEED,
    percent: int = PERCENT,
    spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``docs`` with n (units), form (plain, psm or spm), prefix_chars, middle_chars and output.

    percent: of all rows, how many are drawn to be rearranged; spm_percent: of those, how many with the suffix first.
    """
    names = [s.free_name(docs, name) for name in COLUMNS]
    schema = StructType(list(docs.schema.fields))
    for name, kind in zip(names, COLUMNS.values(), strict=True):
        schema = schema.add(name, kind)
    own = docs.columns

    def run(batches):
        for whole in batches:
            for batch in s.chunks([whole], text_col):
                ids = batch.column(id_col).to_pylist()
                rows = [_row(t, i, seed, percent, spm_percent) for t, i in zip(_bytes(batch.column(text_col)), ids, strict=True)]
                n, form, prefix, middle, output = zip(*rows, strict=True)
                made = [pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64())]
                yield pa.RecordBatch.from_arrays([*batch.columns, *made, _strings(output)], [*own, *names])

    return docs.mapInArrow(run, schema)


def restore(rows: DataFrame, output_col: str = "output", form_col: str = "form", restored_col: str = "restored") -> DataFrame:
    """``rows`` with the text that each output, read with its form alone, was made of; a null output gives the empty text."""
    name = s.free_name(rows, restored_col)
    own = rows.columns

    def run(batches):
        for whole in batches:
            for batch in s.chunks([whole], output_col):
                forms = batch.column(form_col).to_pylist()
                texts = [restored(t, f) for t, f in zip(_bytes(batch.column(output_col)), forms, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns, _strings(texts)], [*own, name])

    return rows.mapInArrow(run, StructType(list(rows.schema.fields)).add(name, "string"))


def digest(text: str) -> F.Column:
    return F.sha2(F.coalesce(s.column(text), F.lit("")), 256)
