"""Token ids of whole texts, by a public tokenizer file and the tokenizers library."""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import stored, texts

END_ID = 2
CACHE_BYTES = 16_000_000  # of the arrays in which a worker keeps known words, some 30 a word
LONGEST_KEPT = 32  # characters; longer words are encoded anew each time
BATCH_CHARS = 2_000_000
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


class KnownWords:
    """Words and their ids in arrays of at most ``limit`` bytes; all are forgotten when
    the next ones do not fit.  A word's number holds until then."""

    def __init__(self, limit: int, kind: str = "<u4") -> None:
        self.limit, self.kind = limit, kind
        self._forget()

    def _forget(self) -> None:
        self.words = pa.array([], pa.large_string())
        self.sizes, self.ids = np.zeros(0, "i4"), np.zeros(0, self.kind)

    @property
    def nbytes(self) -> int:
        return self.words.nbytes + self.sizes.nbytes + self.ids.nbytes

    def find(self, words: pa.Array) -> np.ndarray:
        """Each word's number, -1 for the unknown."""
        if not len(self.words):
            return np.full(len(words), -1)
        return np.array(pc.fill_null(pc.index_in(words, value_set=self.words), -1), "i8")

    def keep(self, words: pa.Array, sizes: np.ndarray, ids: np.ndarray, some: np.ndarray) -> None:
        """Those of ``words``, none of them known yet, that ``some`` marks and that are short."""
        some = some & (pc.utf8_length(words).to_numpy(zero_copy_only=False) <= LONGEST_KEPT)
        words, ids, sizes = words.filter(pa.array(some)), ids[np.repeat(some, sizes)], sizes[some]
        new = words.nbytes + sizes.nbytes + ids.nbytes
        if new + self.nbytes > self.limit:
            self._forget()
        if new <= self.limit:
            self.words = pa.concat_arrays([self.words, words])
            self.sizes, self.ids = np.concatenate([self.sizes, sizes]), np.concatenate([self.ids, ids])


def in_latin_1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def spans(first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of ``length`` each, one after the other."""
    ends = np.cumsum(length)
    return np.repeat(first - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


def without_start(words: pa.Array, start: pa.Array) -> pa.Array:
    """What follows in each word after its part in ``start``."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends or bytes(8), "i8")[words.offset:words.offset + len(words) + 1]
    skip = pc.binary_length(start).to_numpy()
    left = np.diff(ends) - skip
    raw = np.frombuffer(data or b"", "u1")[spans(ends[:-1] + skip, left)]
    cuts = np.concatenate([[0], np.cumsum(left)])
    return pa.LargeStringArray.from_buffers(len(left), pa.py_buffer(cuts), pa.py_buffer(raw))


class WordEncoder:
    """Ids of texts with each distinct word encoded once.

    This tokenizer works inside words: nothing in its normaliser, splitter or merges looks
    across a space, tab or line end.  So a text's ids are those of its words in order, and
    a word met before need not be encoded again.  Texts in Latin-1 are lower-cased first,
    which the normaliser would do anyway; letters (that stay letters when normalised) and the ASCII marks after them (no
    apostrophe) are two of its pieces and are looked up and kept on their own, so that a word is known
    with any marks after it.  Any other word goes
    through the tokenizer as it is.  From a quarter of
    ``cache_bytes`` on only words met twice in one batch are kept: most others do not come back.  Known words and pieces are forgotten when they fill ``cache_bytes``; long words are
    never kept.
    """

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        from tokenizers.normalizers import Sequence

        self.tokenizer = Tokenizer.from_file(path)
        self.normalizer, self.as_it_is = self.tokenizer.normalizer, Sequence([])
        with open(path, encoding="utf-8") as file:
            vocabulary = json.load(file)["model"]["vocab"]
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known = KnownWords(cache_bytes, narrowest(path))

    @property
    def held(self) -> int:
        return self.known.nbytes

    @property
    def words(self) -> list[str]:
        return self.known.words.to_pylist()

    def plain(self, text: str) -> bytes:
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        done = [one.ids for one in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, done), "i4", len(done))
        return sizes, np.fromiter(chain.from_iterable(done), self.known.kind, int(sizes.sum()))

    def _pieces(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        text = " ".join(words)
        if in_latin_1(text) and text == text.lower():  # nothing to normalise
            self.tokenizer.normalizer = self.as_it_is
        encoded = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        self.tokenizer.normalizer = self.normalizer
        ids = np.array(encoded[0].ids, self.known.kind)
        cuts = np.flatnonzero(self.ends[np.minimum(ids, len(self.ends) - 1)]) + 1
        if len(cuts) != len(words):  # one of them is not a single piece
            return self._each(words)
        return np.diff(cuts, prepend=0).astype("i4"), ids

    def _learn(self, new: pa.Array, pieces: int) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each new word has, and all their ids; the first ``pieces`` are single pieces."""
        parts = [(np.zeros(0, "i4"), np.zeros(0, self.known.kind))]
        parts += [self._pieces(new[k:min(pieces, k + 5000)].to_pylist()) for k in range(0, pieces, 5000)]
        parts += [self._each(new[k:k + 2000].to_pylist()) for k in range(pieces, len(new), 2000)]
        sizes, ids = zip(*parts, strict=True)
        return np.concatenate(sizes), np.concatenate(ids)

    def _letters(self, stems: pa.Array) -> np.ndarray:
        """Which stems are letters that stay letters when normalised."""
        letters = np.array(pc.ascii_is_alpha(stems))
        other = np.flatnonzero(~np.array(pc.string_is_ascii(stems)))
        some = stems.take(pa.array(other))
        held = some.to_pylist()
        if in_latin_1("".join(held)):  # the normaliser leaves these what they are, but for case
            letters[other] = np.array(pc.utf8_is_alpha(some))
        else:
            letters[other] = [normalize("NFC", s).lower().isalpha() for s in held]
        return letters

    def encode(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and how many each text has."""
        spaced = []
        for text in batch:
            if in_latin_1(text):  # the tokenizer normalises any other
                text = text.lower()
            spaced.append(text.replace("\n", " ").replace("\t", " "))
        split = pc.split_pattern(pa.array(spaced, pa.large_string()), " ")
        del spaced
        coded = split.flatten().dictionary_encode()
        words, codes = coded.dictionary, coded.indices.to_numpy()
        cut = pc.utf8_rtrim(words, characters=MARKS)  # a stem is a word without the marks at its end
        stems = cut.dictionary_encode()
        stem = stems.indices.to_numpy()
        letters = self._letters(stems.dictionary)
        # a word is its letters and its marks where it has letters, else one thing: none of
        # these is also the letters of another word
        two = letters[stem]
        tails = without_start(words, cut)
        tailed = two & (pc.binary_length(tails).to_numpy() > 0)
        marks = tails.filter(pa.array(tailed)).dictionary_encode()
        keys = pa.concat_arrays([
            stems.dictionary.filter(pa.array(letters)), marks.dictionary, words.filter(pa.array(~two)),
        ]).dictionary_encode()  # marks alone may be a word too
        key, n_stems, n_marks = keys.indices.to_numpy(), int(letters.sum()), len(marks.dictionary)
        place = self.known.find(keys.dictionary)
        unknown = np.flatnonzero(place < 0)
        new = keys.dictionary.take(pa.array(unknown))
        new_sizes, new_ids = self._learn(new, int(np.searchsorted(unknown, n_stems + n_marks)))
        place[unknown] = len(self.known.words) + np.arange(len(unknown))
        # the parts of each word as numbers of keys; no marks are the key after the last
        head = np.empty(len(words), "i8")
        head[two] = key[(np.cumsum(letters) - 1)[stem[two]]]
        head[~two] = key[n_stems + n_marks:]
        tail = np.full(len(words), len(place))
        tail[tailed] = key[n_stems:][marks.indices.to_numpy()]
        sizes = np.concatenate([self.known.sizes, new_sizes, np.zeros(1, "i4")])
        pool = np.concatenate([self.known.ids, new_ids])
        first = np.cumsum(sizes, dtype="i8") - sizes
        parts = np.append(place, len(sizes) - 1)[np.stack([head, tail], axis=1)]
        pool = pool[spans(first[parts].reshape(-1), sizes[parts].reshape(-1))]
        times = np.bincount(codes, minlength=len(words))
        often = (np.bincount(head, times, len(place)) + np.bincount(tail, times, len(place) + 1)[:-1])[unknown] > 1
        self.known.keep(new, new_sizes, new_ids, often | (self.held <= self.known.limit // 4))
        sizes = sizes[parts].sum(axis=1)
        length, first = sizes[codes].astype("i8"), (np.cumsum(sizes, dtype="i8") - sizes)[codes]
        word_ends = split.offsets.to_numpy()
        text_ends = np.concatenate([[0], np.cumsum(length)])[word_ends - word_ends[0]]
        return pool[spans(first, length)], np.diff(text_ends)


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    """One encoder per Python worker, so that tasks share what it knows."""
    return WordEncoder(path)


def char_slices(batch: pa.RecordBatch, chars: int = BATCH_CHARS) -> Iterator[pa.RecordBatch]:
    """Slices of about ``chars`` characters of text, however long single texts are."""
    sizes = pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False)
    group = (np.cumsum(sizes) - sizes) // chars
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


SCHEMA = "part int, start long, doc_id long, n_tokens long, ids binary"


def narrowest(path: str) -> str:
    """The numpy kind of the fewest bytes that holds every id of a tokenizer file."""
    with open(path, encoding="utf-8") as file:
        known = json.load(file)
    ids = [*known["model"]["vocab"].values(), *(t["id"] for t in known.get("added_tokens") or ()), END_ID]
    return "<u2" if max(ids) < 1 << 16 else "<u4"


def encode_documents(
    df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
    end_id: int = END_ID, kind: str = "<u4",
) -> DataFrame:
    """The ids of each document and the end id, stored in the shared folder.

    One row per row of ``df``: ``part`` is the task that wrote it, ``start`` the ids of the
    documents before it in that task, ``ids`` little-endian unsigned numbers of ``kind``.  A null text is
    the empty one and gives the end id alone; null and repeated ids stay as they are.  No
    shuffle.  ``tokenizer`` is a file that every executor has.
    """
    end, width = np.array([end_id], kind).tobytes(), np.dtype(kind).itemsize

    def run(batches):
        from pyspark import TaskContext

        part, start, encoder = TaskContext.get().partitionId(), 0, word_encoder(tokenizer)
        for batch in batches:
            for some in char_slices(batch):
                values, sizes = encoder.encode(some.column("text").to_pylist())
                data, ends = values.astype(kind).tobytes(), (width * np.cumsum(sizes)).tolist()
                ids = [data[a:b] + end for a, b in zip([0, *ends], ends, strict=False)]
                sizes = sizes + 1
                starts = start + np.cumsum(sizes) - sizes
                start += int(sizes.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(ids), part, "i4")), pa.array(starts),
                    some.column("doc_id"), pa.array(sizes), pa.array(ids, pa.binary()),
                ], names=["part", "start", "doc_id", "n_tokens", "ids"])
                pa.default_memory_pool().release_unused()  # the worker shares its executor's memory

    return stored(texts(df, id_col, text_col).mapInArrow(run, SCHEMA), "tokens")
