"""Packing by lexical retrieval.

Documents are tokenized once and dealt to shards of bounded size. Each shard is a BM25 inverted
index over its documents; how many documents hold a term is counted over the whole corpus. A seed
document opens a window, and the unused documents that score best for its terms follow it, each
whole, the last one cut where the window ends. What is cut off is the next seed, so that a long
text runs on through neighbouring windows. Only the last window of a shard is not full.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from servery.llm.common import shared_folder

WINDOW = 2048
#: The id that ends every document.
END_ID = 1
#: Documents in a shard; a shard is one task's index.
SHARD_DOCUMENTS = 512
#: Words whose ids a Python worker remembers at a time.
REMEMBERED = 700_000
K1, B = 1.2, 0.75
_SPACE = re.compile("[\\t\\n\\r ]+")
# Control characters that part words for Python, but not for the tokenizer.
_NO_SPACE = "\x1c\x1d\x1e\x1f"
# Words are taken apart at letters, but for those with these characters in them.
_OTHER = re.compile("['Ā-\U0010ffff\xaa\xb5\xba]|<\\|")
_WORD = re.compile("[a-z\xdf-\xf6\xf8-\xff]+")
_LETTERS = re.compile("[a-z\xdf-\xf6\xf8-\xff]+|[^\\t\\n\\r a-z\xdf-\xf6\xf8-\xff]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Remembered(dict):
    """What ``learn`` makes of a word, kept once it was asked for."""

    def __init__(self, learn: Callable[[str], bytes]) -> None:
        self.learn = learn

    def __missing__(self, word: str) -> bytes:
        ids = self.learn(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = ids
        return ids


class Ids:
    """The ids of texts, as bytes of little-endian numbers of one width: those of a text's
    words, one after another, which are remembered. Words of other letters than Latin-1's are
    encoded many at a time, as words of one call."""

    def __init__(self, definition: str, width: str) -> None:
        self.tokenizer, self.width = Tokenizer.from_str(definition), width
        self.known = _Remembered(self._learned)
        size = np.dtype(width).itemsize
        self.codes = [i.to_bytes(size, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.end = self.codes[END_ID]
        # What the tokenizer's own steps make of each letter before its model sees it.
        steps = self.tokenizer.pre_tokenizer
        self.letters = {ord(c): steps.pre_tokenize_str(c)[0][0] for c in map(chr, range(256)) if _WORD.fullmatch(c)}

    def _learned(self, word: str) -> bytes:
        """A word of small Latin-1 letters is one unit to the model as it stands. In any other
        Latin-1 word the tokenizer lowers letters and parts them from all else; but for
        apostrophes, which may begin an ending, and special tokens. The rest takes all the
        tokenizer's steps."""
        if _WORD.fullmatch(word):
            codes = self.codes
            return b"".join([codes[t.id] for t in self.tokenizer.model.tokenize(word.translate(self.letters))])
        if not _OTHER.search(word):
            lowered = word.lower()
            pieces = _LETTERS.findall(lowered)
            if len(pieces) > 1 or lowered != word:
                return b"".join([self.known[piece] for piece in pieces])
        return self._encoded([word])[0]

    def _encoded(self, words: list[str]) -> list[bytes]:
        size = np.dtype(self.width).itemsize
        encoded = self.tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
        ids = np.array(encoded.ids, self.width).tobytes()
        ends = np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(words) + 1)) * size
        ends = ends.tolist()
        return [ids[s:e] for s, e in zip(ends, ends[1:])]

    def _learn(self, met: set[str], step: int = 20_000) -> None:
        """Those of these words that take all the tokenizer's steps."""
        new = met.difference(self.known)
        if len(self.known) + len(new) > REMEMBERED:
            self.known.clear()
            new = met
        rest = [word for word in new if _OTHER.search(word)]
        for at in range(0, len(rest), step):
            some = rest[at : at + step]
            self.known.update(zip(some, self._encoded(some)))

    def of(self, texts: list[str | None]) -> list[bytes]:
        """The ids of whole texts, each with the one that ends it."""
        latin = [_is_latin(text or "") for text in texts]
        words = [_words(text or "", small) for text, small in zip(texts, latin)]
        if not all(latin):
            self._learn(set().union(*[each for each, small in zip(words, latin) if not small]))
        known = self.known
        return [b"".join(map(known.__getitem__, each)) + self.end for each in words]


@lru_cache(maxsize=1)
def _ids(definition: str, width: str) -> Ids:
    """Kept by a Python worker from one task to the next, with the words it remembers."""
    return Ids(definition, width)


def _is_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def _words(text: str, latin: bool) -> list[str]:
    """What the tokenizer encodes one by one: it parts texts at white space. Latin-1 texts are
    lowered at once, which could make special tokens of capitals."""
    if latin and "<|" not in text:
        text = text.lower()
    if any(c in text for c in _NO_SPACE):
        return list(filter(None, _SPACE.split(text)))
    return text.split()


def _slices(texts: list[str | None], characters: int = 1_000_000) -> Iterator[list[str | None]]:
    """The texts in runs of about so many characters."""
    run, size = [], 0
    for text in texts:
        run.append(text)
        size += len(text or "")
        if size >= characters:
            yield run
            run, size = [], 0
    if run:
        yield run


def tokenized(docs: DataFrame, tokenizer: str, shards: int) -> DataFrame:
    """doc_id, shard, and the ids as bytes of 16 bits each, or of 32 for larger vocabularies.
    Stored: tokenizing is the dear part. ``tokenizer`` is the path of its file on the driver."""
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        shared = spark.sparkContext.broadcast(file.read())
    width = _width(Tokenizer.from_str(shared.value).get_vocab_size())

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = _ids(shared.value, width)
        for batch in batches:
            found = [x for run in _slices(batch.iloc[:, 2].tolist()) for x in ids.of(run)]
            yield pd.DataFrame({"doc_id": batch.iloc[:, 0], "shard": batch.iloc[:, 1], "ids": found})

    kind = docs.schema["doc_id"].dataType.simpleString()
    # The text decides besides the id, so rows without an id spread as well.
    shard = F.pmod(F.xxhash64("doc_id", "text"), F.lit(shards)).cast("int")
    rows = docs.select("doc_id", shard.alias("shard"), "text").mapInPandas(encode, f"doc_id {kind}, shard int, ids binary")
    path = f"{shared_folder(spark)}/tokens-{uuid.uuid4().hex}"
    rows.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def document_counts(tokens: DataFrame, width: str, size: int) -> np.ndarray:
    """In how many documents each id occurs. A row for each id of the vocabulary comes back."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts, held = np.zeros(size, np.int64), np.zeros(size, bool)
        for batch in batches:
            for ids in batch["ids"]:
                held[np.frombuffer(ids, width)] = True
                at = np.flatnonzero(held)
                counts[at] += 1
                held[at] = False
        (at,) = counts.nonzero()
        yield pd.DataFrame({"id": at, "n": counts[at]})

    rows = tokens.select("ids").mapInPandas(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(size, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


class Index:
    """The BM25 postings of a shard: for each term the documents that hold it and what it adds
    to their score. Terms that more than half of all documents hold add nothing."""

    def __init__(self, documents: list[np.ndarray], inverse: np.ndarray, mean_length: float) -> None:
        self.n = len(documents)
        lengths = np.array([len(ids) for ids in documents], np.int64)
        ids = np.concatenate(documents)
        worth = inverse[ids] > 0
        # By term, then document: one sort for all of the shard.
        found = ids[worth].astype(np.int64) * self.n + np.repeat(np.arange(self.n), lengths)[worth]
        found.sort()
        first = _first(found)
        tf = np.diff(first, append=len(found))
        term, self.owner = np.divmod(found[first], self.n)
        length = lengths[self.owner]
        self.weight = inverse[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_length))
        self.first = _first(term)
        self.sizes = np.diff(self.first, append=len(term))
        # The terms of each document, by their place among those of the shard.
        place = np.repeat(np.arange(len(self.first)), self.sizes)
        self.places = place[np.argsort(self.owner, kind="stable")]
        self.ends = np.append(0, np.bincount(self.owner, minlength=self.n).cumsum())

    def scores(self, document: int) -> np.ndarray:
        """Of every document of the shard, for the terms of one of them."""
        at = self.places[self.ends[document] : self.ends[document + 1]]
        first, sizes = self.first[at], self.sizes[at]
        rows = np.repeat(first - np.append(0, sizes.cumsum()[:-1])[: len(sizes)], sizes) + np.arange(sizes.sum())
        return np.bincount(self.owner[rows], self.weight[rows], minlength=self.n)


def _first(values: np.ndarray) -> np.ndarray:
    """Where each run of equal values begins."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])


def windows(lengths: list[int], scores, window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) of each piece. ``scores`` gives, for a seed,
    the scores of all documents; the larger come first, then the earlier."""
    unused = np.ones(len(lengths), bool)
    number, seed, start = 0, 0, 0
    while True:
        if seed is None:
            return
        unused[seed] = False
        take = min(window, lengths[seed] - start)
        yield seed, start, take, number, 0
        used, start = take, start + take
        if start < lengths[seed]:  # the seed alone fills the window and runs on
            number += 1
            continue
        rest = None
        if used < window and unused.any():
            order = np.argsort(-scores(seed), kind="stable")
            for d in order[unused[order]].tolist():
                take = min(window - used, lengths[d])
                unused[d] = False
                yield d, 0, take, number, used
                used += take
                if take < lengths[d]:
                    rest = d
                if used == window:
                    break
        number += 1
        if rest is not None:
            seed, start = rest, take
        else:
            seed, start = (int(unused.argmax()), 0) if unused.any() else (None, 0)


def packed(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """The pieces of all documents: doc_id, ``start``, ``length``, ``ids`` (little-endian 32-bit
    numbers), ``doc_tokens``, ``sequence_id``, ``offset``.

    NULL and empty texts are the end id alone. Repeated rows are packed as often as they come.
    Rows of a shard are taken in the order of id and ids, so the result can be repeated.
    """
    tokenizer = tokenizer or default_tokenizer()
    size = Tokenizer.from_file(tokenizer).get_vocab_size()
    width = _width(size)
    n = docs.count()
    tokens = tokenized(docs, tokenizer, max(1, -(-n // SHARD_DOCUMENTS)))
    counts = document_counts(tokens, width, size)
    inverse = np.maximum(0, np.log((n - counts + 0.5) / (counts + 0.5)))
    total = tokens.agg(F.sum(F.octet_length("ids"))).first()[0] or 0
    mean_length = max(1.0, total / np.dtype(width).itemsize / max(n, 1))
    shared = docs.sparkSession.sparkContext.broadcast(inverse)

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_id", "ids"], na_position="last", kind="stable")
        documents = [np.frombuffer(ids, width) for ids in rows["ids"]]
        index = Index(documents, shared.value, mean_length)
        lengths = [len(ids) for ids in documents]
        pieces = list(windows(lengths, index.scores, window))
        d, start, length, number, offset = (np.array(c, np.int64) for c in zip(*pieces))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].to_numpy()[d],
                "start": start,
                "length": length,
                "ids": [documents[p[0]][p[1] : p[1] + p[2]].astype("<u4").tobytes() for p in pieces],
                "doc_tokens": np.array(lengths, np.int64)[d],
                "sequence_id": (int(rows["shard"].iloc[0]) << 31) + number,
                "offset": offset,
            }
        )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    return tokens.groupBy("shard").applyInPandas(pack, schema)


def packing_digest(docs: DataFrame) -> DataFrame:
    """The pieces, with a check sum in the place of their ids."""
    pieces = packed(docs.select("doc_id", "text"))
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
