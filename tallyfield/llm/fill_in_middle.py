"""Fill-in-middle: texts cut at unit ranks that one Aho-Corasick scan finds, reordered around sentinels, and rebuilt."""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

WHITE = " \t\n\x0b\x0c\r"
SENTINELS = ("<P>", "<S>", "<M>")  # before the prefix, the suffix and the middle
_ROWS, _BYTES = 256, 8 << 20  # rows turned into Python texts at once, characters sent back at once
_state: dict = {}


def _scanner(sentinels: tuple[str, ...]):
    """The automaton over white space (value 0) and sentinels (1 to 3)."""
    if sentinels not in _state:
        import ahocorasick

        made = ahocorasick.Automaton()
        for sign in WHITE:
            made.add_word(sign, 0)
        for i, word in enumerate(sentinels):
            made.add_word(word, i + 1)
        made.make_automaton()
        _state[sentinels] = made
    return _state[sentinels]


def scan(text: str, sentinels: tuple[str, ...] = SENTINELS) -> tuple[np.ndarray, bool]:
    """Places of the white space of a text, in code points, and whether it spells a sentinel."""
    found = np.array([at << 2 | kind for at, kind in _scanner(sentinels).iter(text)], np.int64)
    white = found & 3 == 0
    return found[white] >> 2, not white.all()


def unit_ends(white: np.ndarray, length: int) -> np.ndarray:
    """Where each unit ends: a gap between white space is a word, and white space after the last word is a unit of its own."""
    after = np.append(white, length)
    ends = after[np.diff(after, prepend=-1) > 1]
    return np.append(ends, length) if len(white) and white[-1] == length - 1 else ends


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", seed: int = 42, rate: int = 50, spm: int = 80,
    sentinels: tuple[str, str, str] = SENTINELS, carry: tuple[str, ...] = (),
) -> DataFrame:
    """Rows (``id_col``, *carry, n, form, prefix_chars, middle_chars, output), one for each of ``docs``.

    A text has n units: words with the white space before them, and white space after the last word.  Four numbers from
    the SHA-256 of ``seed:id`` draw two cuts between units and the form: ``plain`` (the text as it is) for all but
    ``rate`` in a hundred, else ``spm`` for ``spm`` in a hundred of these (suffix, prefix, middle), else ``psm``.
    Texts that are empty or spell a sentinel stay plain; their lengths, in code points, are null.

    Null text is empty and a null id has no digits; rows that repeat an id and text repeat the result.  Texts are scanned whole,
    one at a time, by one automaton; what follows needs only the places of white space.  Nothing is shuffled.  Columns
    of ``docs`` that are not named here are not read; a carried one named like a result raises a ValueError.
    """
    made = [("n", LongType()), ("form", StringType()), ("prefix_chars", LongType()), ("middle_chars", LongType()), ("output", StringType())]
    kept = [id_col, *carry]
    if clash := set(kept) & {name for name, _ in made}:
        raise ValueError(f"results have these names: {sorted(clash)}")
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    drawn = [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i}") for i in range(4)]
    rows = docs.select(F.struct(*kept).alias("kept"), F.col(text).alias("text"), *drawn)
    schema = StructType([rows.schema["kept"], *[StructField(name, kind) for name, kind in made]])
    first, second, third = sentinels

    def reorder(whole: str, h: list[int]) -> tuple:
        white, spelt = scan(whole, sentinels)
        ends = unit_ends(white, len(whole))
        n = len(ends)
        if not whole or spelt or h[2] % 100 >= rate:
            return n, "plain", None, None, whole
        lo, hi = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (int(ends[k - 1]) if k else 0 for k in (lo, hi))
        prefix, middle, suffix = whole[:a], whole[a:b], whole[b:]
        if h[3] % 100 < spm:
            return n, "spm", a, b - a, f"{second}{suffix}{first}{prefix}{third}{middle}"
        return n, "psm", a, b - a, f"{first}{prefix}{second}{suffix}{third}{middle}"

    def transform(batches):
        import pyarrow as pa

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.large_string()]

        def packed(batch, lo: int, hi: int, out: list):
            columns = [pa.array(values, kind) for values, kind in zip(zip(*out, strict=True), kinds, strict=True)]
            columns[-1] = columns[-1].cast(pa.string())
            return pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), *columns], names=schema.names)

        for batch in batches:
            begun, out, size = 0, [], 0
            for lo in range(0, batch.num_rows, _ROWS):
                texts = batch.column(1).slice(lo, _ROWS).to_pylist()
                draws = zip(*(batch.column(i).slice(lo, _ROWS).to_pylist() for i in range(2, 6)), strict=True)
                for whole, h in zip(texts, draws, strict=True):
                    out.append(reorder(whole or "", h))
                    size += len(whole or "")
                    if size >= _BYTES:
                        yield packed(batch, begun, begun + len(out), out)
                        begun, out, size = begun + len(out), [], 0
            if out:
                yield packed(batch, begun, begun + len(out), out)

    return rows.mapInArrow(transform, schema).select("kept.*", *[name for name, _ in made])


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made from; null where either is null.

    A reordered text spells each sentinel once: the text itself spells none, and none can arise where two pieces meet, since
    a sentinel's first and last signs occur in it nowhere else.
    """
    first, second, third = sentinels
    part = F.split(output, "|".join(re.escape(s) for s in sentinels))
    at = {"psm": (1, 3, 2), "spm": (2, 3, 1)}  # places of prefix, middle and suffix
    joined = {name: F.concat(*[F.get(part, i) for i in places]) for name, places in at.items()}
    return F.when(form == "plain", output).when(form == "psm", joined["psm"]).when(form == "spm", joined["spm"])
