"""Token counts of whole texts by a byte-pair piece model; long texts are cut and resynchronised.

A text of at most ``chunk`` bytes is encoded at once. A longer one is cut into chunks of that size,
each of which also holds the first ``overlap`` bytes of the next one. Chunks of one text are dealt
to all tasks and encoded there with the byte offset of every token. Two neighbours are spliced
behind a token that both have in their overlap, same bounds and same id; where there is none, the
text is cut again with chunk and overlap twice as wide, until one is found or one chunk is left.

Why a splice is exact: byte-pair encoding merges the best neighbours first (score, then the left
one), so a list of tokens is the encoding of its text if and only if each two neighbouring tokens
are the encoding of theirs. (Take the first merge across a token's bounds. Until then the merges
inside two neighbouring tokens are those made when the two stand alone, so it would happen there
too.) Behind a common token every two neighbours of the spliced list are neighbours in one of the
chunks, which are encodings. The space that the library puts in front of each chunk is part of
the first token only, and counts for the first chunk alone.

Defined results: NULL and empty texts have no tokens; repeated rows and rows with a NULL doc_id are
rows of their own; an empty table gives no rows; other columns are not looked at. Bytes that are
not UTF-8 are counted as the library reads them. Texts are told apart by their position in the
scan, so ``docs`` comes straight from storage.
"""

from __future__ import annotations

import codecs
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pseudora.llm import textvec
from pseudora.llm.store import shuffle_width, stored

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
CHUNK = 1 << 15
OVERLAP = 1 << 9
_BATCH_BYTES = 1 << 22
_SPACE = b" "
_PREFIX = 3  # bytes of the mark that stands for a space, also of the one put in front of a text
_ID_BITS = 20


def _processor(model: str):
    """The model of that path, or of that name among the installed public tokenizers."""
    import sentencepiece

    if not os.path.exists(model):
        import public_tokenizers

        model = public_tokenizers.path(model)
    return sentencepiece.SentencePieceProcessor(model_file=model)


def _token_bytes(processor) -> np.ndarray:
    """Bytes of normalised text that each token stands for."""
    ids = range(processor.get_piece_size())
    sizes = [1 if processor.is_byte(k) else len(processor.id_to_piece(k).encode()) for k in ids]
    return np.array(sizes, dtype=np.int64)


def _count_whole(model: str):
    """Token counts of texts that are encoded at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(model)
        for batch in batches:
            texts = [t or b"" for t in batch.column("_text").to_pylist()]
            counts = []
            for first, last in textvec.sub_batches(texts):
                counts += map(len, processor.encode(texts[first:last], num_threads=1))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    return run


def _character_start(text: bytes, at: int) -> int:
    """The place of a character's first byte, at ``at`` or up to three bytes before."""
    back = 0
    while at < len(text) and back < _PREFIX and text[at - back] & 0xC0 == 0x80:
        back += 1
    return at - back


def chunks(text: bytes, size: int, overlap: int) -> Iterator[tuple[int, int, bytes]]:
    """(head, tail, data) of each chunk of a text, cut between characters.

    ``head`` bytes are shared with the chunk before; the next one starts at ``tail``, which is
    -1 for the last. ``size`` is at least twice ``overlap``, so no two overlaps touch.
    """
    starts = [_character_start(text, at) for at in range(0, len(text), size)]
    ends = [_character_start(text, min(at + overlap, len(text))) for at in starts[1:]]
    head = 0
    for start, after, end in zip(starts, starts[1:], ends):
        yield head, after - start, text[start:end]
        head = end - after
    yield head, -1, text[starts[-1] :]


def _one_mark_a_byte(error: UnicodeError) -> tuple[str, int]:
    return "\ufffd" * (error.end - error.start), error.end


def _readable(text: bytes) -> bytes:
    """The text as the library reads it, with a mark for each byte that is not UTF-8."""
    try:
        text.decode()
    except UnicodeDecodeError:
        codecs.register_error("one_mark_a_byte", _one_mark_a_byte)
        return text.decode(errors="one_mark_a_byte").encode()
    return text


def _cut(size: int, overlap: int):
    """Rows of chunks, a few megabytes at a time."""
    names = ["row", "doc_id", "n_bytes", "part", "head", "tail", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, texts = (batch.column(name) for name in ("doc_id", "row", "_text"))
            held: list[tuple] = []

            def flushed() -> pa.RecordBatch:
                at, n_bytes, part, head, tail, data = zip(*held, strict=True)
                numbers = [pa.array(column, pa.int64()) for column in (n_bytes, part, head, tail)]
                return pa.RecordBatch.from_arrays(
                    [rows.take(pa.array(at)), ids.take(pa.array(at)), *numbers, pa.array(data, pa.binary())], names=names
                )

            for at, text in enumerate(texts):
                text = text.as_py()
                for part, (head, tail, data) in enumerate(chunks(_readable(text), size, overlap)):
                    held.append((at, len(text), part, head, tail, data))
                    if len(held) * size >= _BATCH_BYTES:
                        yield flushed()
                        held.clear()
            if held:
                yield flushed()

    return run


def _normal_size(data: bytes) -> int:
    """Bytes of a text in which each space has become a mark."""
    return len(data) + (_PREFIX - 1) * data.count(_SPACE)


def seam_tokens(processor, sizes: np.ndarray, head: int, tail: int, data: bytes) -> tuple:
    """Token count of a chunk, and its tokens (end << 20 | id) at the seams after and before it.

    Ends count from where the right chunk of the seam starts.
    """
    ids = np.array(processor.encode(data), dtype=np.int64)
    ends = np.cumsum(sizes[ids]) - _PREFIX
    if len(ids) and ends[-1] != _normal_size(data):
        raise ValueError("the model changes texts in other ways than marking spaces")
    past = ends - _normal_size(data[:tail])
    left = (past[past > 0] << _ID_BITS) | ids[past > 0] if tail >= 0 else None
    within = ends <= _normal_size(data[:head])
    right = (ends[within] << _ID_BITS) | ids[within]
    return len(ids), left, right


def _encode(model: str):
    """A row per chunk with the seam after it, and one with the seam before it."""
    names = ["row", "seam", "doc_id", "n_bytes", "n", "left", "right"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        processor = _processor(model)
        sizes = _token_bytes(processor)
        for batch in batches:
            found = []
            fields = [batch.column(name) for name in ("part", "head", "tail", "data")]
            for at, values in enumerate(zip(*fields, strict=True)):
                part, head, tail, data = (value.as_py() for value in values)
                count, left, right = seam_tokens(processor, sizes, head, tail, data)
                found.append((at, part, count, left, None))
                if part:
                    found.append((at, part - 1, 0, None, right))
            if not found:
                continue
            at, seam, count, left, right = zip(*found, strict=True)
            spots = pa.array(at)
            row, doc_id, n_bytes = (batch.column(name).take(spots) for name in ("row", "doc_id", "n_bytes"))
            numbers = [pa.array(column, pa.int64()) for column in (seam, count)]
            lists = [pa.array(column, pa.list_(pa.int64())) for column in (left, right)]
            yield pa.RecordBatch.from_arrays([row, numbers[0], doc_id, n_bytes, numbers[1], *lists], names=names)

    return run


def _spliced(encoded: DataFrame) -> DataFrame:
    """Tokens of each text, and whether a seam of it has no common token (``apart``)."""
    carried = [F.first(name, True).alias(name) for name in ("doc_id", "n_bytes")]
    seams = encoded.groupBy("row", "seam").agg(
        *carried, F.sum("n").alias("n"), F.first("left", True).alias("left"), F.first("right", True).alias("right")
    )
    seams = seams.withColumn("at", F.array_min(F.array_intersect("left", "right")))
    # Of a left chunk the tokens up to the splice count, of a right one those behind it.
    beyond = F.size(F.filter("left", lambda x: x > F.col("at")))
    before = F.size(F.filter("right", lambda x: x <= F.col("at")))
    last = F.col("left").isNull()
    return seams.groupBy("row").agg(
        *carried,
        F.sum(F.col("n") - F.when(last, 0).otherwise(beyond + before)).alias("n_tokens"),
        F.max(~last & F.col("at").isNull()).alias("apart"),
    )


def count_tokens(
    docs: DataFrame, *, model: str = MODEL, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document."""
    if chunk < 2 * overlap or overlap < 1:
        raise ValueError("a chunk holds at least two overlaps")
    text = F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    texts = docs.select("doc_id", text.alias("_text")).withColumn("n_bytes", F.octet_length("_text").cast("long"))
    kept = f"doc_id {dict(docs.dtypes)['doc_id']}, n_bytes long"
    counted = texts.where(F.col("n_bytes") <= chunk).mapInArrow(_count_whole(model), f"{kept}, n_tokens long")

    long = texts.withColumn("row", F.monotonically_increasing_id()).where(F.col("n_bytes") > chunk)
    left = long
    while True:
        cut = left.mapInArrow(_cut(chunk, overlap), f"row long, {kept}, part long, head long, tail long, data binary")
        dealt = cut.repartition(shuffle_width(docs.sparkSession), "row", "part")
        encoded = dealt.mapInArrow(_encode(model), f"row long, seam long, {kept}, n long, left array<long>, right array<long>")
        done = stored(_spliced(encoded), "token-counts")
        counted = counted.unionByName(done.where("NOT apart").select("doc_id", "n_bytes", "n_tokens"))
        apart = done.where("apart").select("row")
        if apart.isEmpty():
            return counted.withColumn("over_limit", F.col("n_tokens") > limit)
        left = long.join(apart, "row", "left_semi")
        chunk, overlap = 2 * chunk, 2 * overlap
