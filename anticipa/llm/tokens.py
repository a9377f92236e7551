"""Token ids of whole texts by a public tokenizer, with a bounded cache of words."""

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

CACHED_WORDS = 200_000
ROWS_AT_ONCE = 2000  # texts that go into a batch of ids
_BYTES_AT_ONCE = 6_000_000  # of texts whose words are looked up together, each distinct one once
_SIMPLE = "\u0130"  # letters before this one are single code points in normal form with one lower-case letter each
_LETTERS = "".join(filter(str.isalpha, map(chr, range(ord(_SIMPLE)))))
_SIMPLE_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f"  # the same as ranges


class WordCache:
    """Encodes texts word by word, each new word once.

    The tokenizer's pre-tokens never cross white space, so the ids of a text are those of its parts between spaces and
    line breaks; letters and the punctuation after them are separate pre-tokens too, so only these parts are kept, in lower
    case where the tokenizer drops it. Ids are kept as little-endian bytes of `dtype`. Once `limit` parts are in use
    the cache starts anew and keeps those of the time before as `older`, from which parts still in use come back.
    """

    def __init__(self, path: str, limit: int = CACHED_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.ends = np.zeros(self.tokenizer.get_vocab_size(), bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends[i] = token.endswith("</w>")
        # For words of simple letters in lower case, which normal forms and patterns leave whole.
        bytes_of = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.simple = normalizers.Sequence([]), pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), bytes_of])
        self.whole = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        self.limit = limit
        self.cache: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        """Put new parts into the cache."""
        letters, learnt, width = [w for w in words if w.isalpha()], {}, self.dtype.itemsize
        simple = [w for w in letters if w.isascii() or max(w) < _SIMPLE]
        other = [w for w in letters if max(w) >= _SIMPLE]
        for steps, plain in ((self.simple, simple), (self.whole, other)):
            self.tokenizer.normalizer, self.tokenizer.pre_tokenizer = steps
            for k in range(0, len(plain), 256):  # one pre-token each, so whole runs can be encoded at once
                part = plain[k : k + 256]
                ids = np.array(self.tokenizer.encode_batch_fast([" ".join(part)], add_special_tokens=False)[0].ids)
                stops = np.flatnonzero(self.ends[ids]) + 1
                if len(stops) == len(part) and stops[-1] == len(ids):
                    raw, stops = ids.astype(self.dtype).tobytes(), (stops * width).tolist()
                    learnt.update((word, raw[a:b]) for word, a, b in zip(part, [0, *stops], stops))
        rest = [w for w in words if w not in learnt]
        for word, found in zip(rest, self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)):
            learnt[word] = np.array(found.ids, self.dtype).tobytes()
        self.cache.update(learnt)

    def _ids(self, parts: pa.Array) -> pa.Array:
        """The ids of each part, looked up once for each distinct one."""
        coded, cache, older = parts.dictionary_encode(), self.cache, self.older
        known = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in known if p not in cache]
        cache.update((p, older[p]) for p in new if p in older)
        self._learn([p for p in new if p not in older])
        return pa.array([cache[p] for p in known], pa.large_binary()).take(coded.indices)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        return self.encode_array(pa.array(texts, pa.string())).to_pylist()

    def encode_array(self, texts: pa.Array, end: bytes = b"") -> pa.Array:
        """`encode` from strings to binaries, each with `end` after its ids. No text becomes a Python object, only new words."""
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        parts, start = [], 0
        while start < len(texts):
            before = int(sizes[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, before + _BYTES_AT_ONCE, "right")))
            ids = self._encode(texts.slice(start, stop - start))
            parts.append(pc.binary_join_element_wise(ids, *(pa.scalar(x, pa.binary()) for x in (end, b""))) if end else ids)
            start = stop
            pa.default_memory_pool().release_unused()
        return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())

    def _encode(self, texts: pa.Array) -> pa.Array:
        if len(self.cache) > self.limit:
            self.cache, self.older = {"": b""}, self.cache
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary
        stripped = pc.utf8_rtrim(words, characters=punctuation)
        simple = pc.match_substring_regex(stripped, f"^[{_SIMPLE_LETTERS}]+$")
        others = words.filter(pc.invert(simple)).to_pylist()
        # The tokenizer drops letter case itself. Words that are no letters before their last punctuation stay whole.
        bodies = [b if (b := w.rstrip(punctuation)).isalpha() else w for w in others]
        tails = [w[len(b) :] for w, b in zip(others, bodies)]
        body = pa.concat_arrays([pc.utf8_lower(stripped.filter(simple)), pa.array(bodies, pa.string())])
        tail = pa.concat_arrays([pc.utf8_ltrim(words.filter(simple), characters=_LETTERS), pa.array(tails, pa.string())])
        ids = pc.binary_join_element_wise(self._ids(body), self._ids(tail), pa.scalar(b"", pa.large_binary()))
        chosen = simple.to_numpy(zero_copy_only=False)
        place = np.where(chosen, np.cumsum(chosen), len(chosen) - len(others) + np.cumsum(~chosen)) - 1
        laid = ids.take(pa.array(place[coded.indices.to_numpy()]))
        ends = np.frombuffer(laid.buffers()[1], np.int64, len(laid) + 1)[split.offsets.to_numpy()]
        whole = [None, pa.py_buffer(ends.tobytes()), laid.buffers()[2]]
        return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(texts), whole).cast(pa.binary())


@lru_cache(maxsize=2)
def worker_cache(path: str) -> WordCache:
    return WordCache(path)


def id_bytes(text: Column, path: str, end_id: int | None = None) -> Column:
    """Binary column: the ids of `text` (null: empty), little-endian and unsigned, then `end_id`.

    Two bytes an id where the vocabulary allows, else four. `path` must be readable on every executor.
    """

    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = worker_cache(path)
        end = b"" if end_id is None else np.array([end_id], words.dtype).tobytes()
        for texts in batches:
            yield words.encode_array(texts, end)

    return encode(F.coalesce(text, F.lit("")))


@lru_cache
def id_width(path: str) -> int:
    """Bytes of an id, read off the vocabulary: the driver needs no tokenizer, and its memory does not grow run by run."""
    known = json.loads(Path(path).read_text(encoding="utf-8"))
    vocabulary = known["model"]["vocab"]
    ids = vocabulary.values() if isinstance(vocabulary, dict) else range(len(vocabulary))
    most = max([*ids, *(t["id"] for t in known.get("added_tokens") or [])])
    return 2 if most < 1 << 16 else 4
