"""BPE encoding and decoding of a text column.

Each task streams Arrow batches through one ``WordCodec``: a bounded-lookahead transducer encodes, an
incremental byte-to-text machine decodes from the ids alone. No shuffle; memory is one batch plus the
bounded memo of words.

Null text is encoded as empty text, an empty text has no ids and decodes to empty text. Repeated rows
give repeated rows; other columns never reach Python.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from gridpulse.llm.common import pick
from gridpulse.llm.wordbpe import StreamEncoder, WordCodec, word_codec

VOCABULARY = "word_bpe_49k.json"
CHUNK = 1 << 16
FIELDS = {
    "ids": ("array<int>", pa.list_(pa.int32())),
    "decoded": ("string", pa.string()),
    "n_tokens": ("bigint", pa.int64()),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def encode_text(codec: WordCodec, text: str) -> bytes:
    """Ids of one text, read in chunks of constant size."""
    stream = StreamEncoder(codec)
    parts = [stream.feed(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)]
    return b"".join([*parts, stream.finish()])


def encode_texts(codec: WordCodec, texts: Iterable[str]) -> Iterator[bytes]:
    """Ids of each text; short ones share a group, long ones are streamed."""
    for long, some in itertools.groupby(texts, lambda t: len(t) > CHUNK):
        yield from (encode_text(codec, t) for t in some) if long else codec.encode_all(some)


def decode_ids(codec: WordCodec, ids: bytes):
    """The text of ids, in pieces."""
    view, decoder = memoryview(ids).cast("I"), codec.decoder()
    for i in range(0, len(view), CHUNK):
        yield decoder.feed(view[i : i + CHUNK].tolist())
    yield decoder.finish()


def _row(codec: WordCodec, ids: bytes, want: tuple[str, ...]) -> dict:
    row: dict = {"n_tokens": len(ids) // 4}
    if "ids" in want:
        row["ids"] = memoryview(ids).cast("I").tolist()
    if "ids_sha256" in want:
        row["ids_sha256"] = hashlib.sha256(ids).hexdigest()
    if "decoded" in want:
        row["decoded"] = "".join(decode_ids(codec, ids))
    if "decoded_sha256" in want:
        digest = hashlib.sha256()
        for part in decode_ids(codec, ids):
            digest.update(part.encode())
        row["decoded_sha256"] = digest.hexdigest()
    return row


def round_trip(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    want: tuple[str, ...] = ("ids", "decoded"),
    vocabulary: str | None = None,
) -> DataFrame:
    """``id_col`` and the wanted columns of ``FIELDS`` for every row of ``df``."""
    path = vocabulary or public_tokenizers.path(VOCABULARY)
    rows = pick(df, id=id_col, text=text_col)
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches):
        codec = word_codec(path)
        for batch in batches:
            coded = encode_texts(codec, (text.as_py() or "" for text in batch.column("text")))
            out = [_row(codec, ids, want) for ids in coded]
            columns = [pa.array([r[w] for r in out], FIELDS[w][1]) for w in want]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=[id_col, *want])

    schema = ", ".join([f"`{id_col}` {kind}", *(f"{w} {FIELDS[w][0]}" for w in want)])
    return rows.mapInArrow(run, schema)
