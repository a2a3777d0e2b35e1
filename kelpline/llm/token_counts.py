"""Token counts of whole texts, exactly as a public tokenizer's library gives them."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kelpline.llm.bytetools import buffers, slices

#: Pieces whose token counts a worker remembers before it starts anew (about 60 MB).
CACHE_PIECES = 400_000
#: Bytes of text that are encoded in one go.
BATCH_BYTES = 1 << 20


def _safe(piece: str) -> bool:
    """Can a text be cut before a space that is followed by this piece?"""
    return piece != "" and ("!" <= piece[0] <= "~" or piece[0].isalnum())


class _Counter:
    """Counts tokens by pieces.

    A text may be cut before any single space that a visible character follows: a byte-level
    pre-tokenizer always starts a new word at such a space and an added special token holds none, so
    the counts of the pieces add up to that of the text. Pieces repeat, so each is encoded once.
    """

    def __init__(self, model: bytes, kind: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.kind, self.cache = kind, {}
        if kind == "json":
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_str(model.decode("utf-8"))
            self.tokenizer.no_truncation()
            self.tokenizer.no_padding()
            self.by_pieces = '"ByteLevel"' in str(self.tokenizer.pre_tokenizer) or "ByteLevel(" in str(self.tokenizer.pre_tokenizer)
            self.by_pieces &= self.tokenizer.normalizer is None and all(" " not in x.content and not x.lstrip and not x.rstrip and not x.single_word for x in self.tokenizer.get_added_tokens_decoder().values())
        else:
            import sentencepiece

            self.tokenizer = sentencepiece.SentencePieceProcessor(model_proto=model)
            self.by_pieces = False

    def encode(self, texts: list[str]) -> list[int]:
        if self.kind == "json":
            return [len(x) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return [len(x) for x in self.tokenizer.encode(texts, num_threads=1)]

    def lengths(self, texts: list[str]) -> list[int]:
        if not self.by_pieces:
            return self.encode(texts)
        split = [t.split(" ") for t in texts]
        heads = self.encode([s[0] for s in split])
        cache = self.cache
        if len(cache) > CACHE_PIECES:
            cache.clear()
        new = set()
        for s in split:
            del s[0]
            new.update(s)
        new = [p for p in new if p not in cache]
        good = [p for p in new if _safe(p)]
        # a piece that no cut may precede makes the sum NaN, and such a text is cut with more care below
        cache.update(dict.fromkeys(new, float("nan")))
        for lo in range(0, len(good), 20_000):
            part = good[lo : lo + 20_000]
            cache.update(zip(part, self.encode([" " + p for p in part]), strict=True))
        sums = [h + sum(map(cache.__getitem__, s)) for h, s in zip(heads, split, strict=True)]
        return [n if n == n else self.careful(t) for n, t in zip(sums, texts, strict=True)]

    def careful(self, text: str) -> int:
        parts, held = [], None
        for k, piece in enumerate(text.split(" ")):
            if k and _safe(piece):
                parts.append(held)
                held = " " + piece
            else:
                held = piece if held is None else f"{held} {piece}"
        return sum(self.encode([*parts, held]))


def count_tokens(df: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > limit) of every row's whole text.

    ``tokenizer_path`` names a ``.json`` (tokenizers) or ``.model`` (sentencepiece) file on the driver;
    its bytes, a few MB whatever the data, travel to the workers in one broadcast. Only lengths leave
    the workers. Without begin, end or added special tokens; special strings inside a text are handled
    as the library does by default. Null and empty texts have 0 bytes and 0 tokens; rows with equal or
    null ids each keep their own row; other columns are ignored, whatever their names.
    """
    with open(tokenizer_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    kind = "json" if tokenizer_path.endswith(".json") else "model"
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(model.value, kind)
        for part in slices(batches, "text", BATCH_BYTES):
            _, at = buffers(part.column("text"))
            tokens = counter.lengths([t or "" for t in part.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(at[1:] - at[:-1], pa.int64()), pa.array(tokens, pa.int64()), pa.array([n > limit for n in tokens], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    kind_of_id = docs.schema["doc_id"].dataType
    schema = T.StructType([T.StructField("doc_id", kind_of_id), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])
    return docs.mapInArrow(run, schema)
