"""Token counts of whole texts; huge texts are encoded in overlapping chunks and spliced."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import texts_of

MODEL = "piece_bpe_32k.model"
CHUNK = 1 << 15  # characters encoded at once
OVERLAP = 256  # characters that neighbouring chunks share at first


class Encoder:
    """Token counts and token starts of one tokenizer file, without begin, end or added special tokens."""

    def __init__(self, name: str):
        import public_tokenizers

        path = name if os.path.isabs(name) else public_tokenizers.path(name)
        self.pieces = path.endswith(".model")
        if self.pieces:
            import sentencepiece

            self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        else:
            os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
            from tokenizers import Tokenizer

            self.model = Tokenizer.from_file(path)
            self.model.no_truncation()
            self.model.no_padding()

    def counts(self, texts: list[str]) -> list[int]:
        if self.pieces:
            return [len(ids) for ids in self.model.encode(texts, num_threads=1)] if texts else []
        return [len(e.ids) for e in self.model.encode_batch(texts, add_special_tokens=False)] if texts else []

    def starts(self, text: str) -> np.ndarray:
        """Character offset at which each token starts."""
        if not self.pieces:
            return np.array([a for a, _ in self.model.encode(text, add_special_tokens=False).offsets], np.int64)
        raw = np.frombuffer(text.encode("utf-8"), np.uint8)
        chars = np.cumsum((raw & 0xC0) != 0x80) - 1  # character of each byte
        chars = np.append(chars, len(text))
        return chars[np.array([p.begin for p in self.model.encode(text, return_type="proto").pieces], np.int64)]


@lru_cache(maxsize=4)
def encoder(name: str) -> Encoder:
    return Encoder(name)


def stable(text: str, at: int) -> bool:
    """No token can reach over ``at``: a letter or digit, then one space, then a letter.

    Both kinds of tokenizer open a new word with the space before it, and no vocabulary entry holds a space
    after another character; so what stands on either side can't change the split here.
    """
    return 0 < at < len(text) - 1 and text[at] == " " and text[at - 1].isalnum() and text[at + 1].isalpha()


def spliced_count(text: str, starts: Callable[[str], np.ndarray], chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of ``text`` from overlapping chunks.

    Of two neighbouring chunks, tokens are taken from the left one up to a stable position at which both start a
    token, and from the right one from there. Without such a position the right chunk starts earlier, twice as
    far each time; the last resort joins both chunks into one.
    """
    total, begin = 0, 0  # tokens before ``begin`` are counted; ``begin`` is 0 or a stable position
    held, offset = starts(text[:chunk]), 0  # of the chunk that covers ``begin``
    end = min(chunk, len(text))
    while end < len(text):
        reach, cut = overlap, None
        while cut is None:
            low = max(begin, end - reach)
            until = min(low + reach + chunk, len(text))
            if low <= begin:  # no room to align: encode on from the last proven position
                low = max(0, begin - 1)
                held, offset = starts(text[low:until]), low
                cut, right = begin, held
                break
            right = starts(text[low:until])
            common = np.intersect1d(held[held + offset > max(begin, low)] + offset, right[right > 0] + low)
            cut = next((int(p) for p in common[::-1] if p < end - 1 and stable(text, int(p))), None)
            reach *= 2
        total += int(np.count_nonzero((held + offset >= begin) & (held + offset < cut)))
        begin, held, offset, end = cut, right, low, until
    return total + int(np.count_nonzero(held + offset >= begin))


def count_tokens(docs: DataFrame, model: str = MODEL, limit: int = 4096, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every whole text.

    ``model`` names a file of ``public_tokenizers`` or an absolute path that every executor has. A null or empty
    text has no bytes and no tokens; repeated rows are counted each; an empty table gives no rows; other columns
    are ignored. Memory follows one Arrow batch and one chunk, not the longest text times its tokens.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model_ = encoder(model)
        for batch in batches:
            for piece in (batch.slice(i, 256) for i in range(0, batch.num_rows, 256)):
                texts = texts_of(piece.column(1))
                counts = np.zeros(len(texts), np.int64)
                short = [i for i, t in enumerate(texts) if 0 < len(t) <= chunk]
                counts[short] = model_.counts([texts[i] for i in short])
                for i, t in enumerate(texts):
                    if len(t) > chunk:
                        counts[i] = spliced_count(t, model_.starts, chunk, overlap)
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()), pa.array(counts)], ["doc_id", "n_bytes", "n_tokens"])

    counted = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
