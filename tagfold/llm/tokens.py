"""Token ids of whole texts by the public lower-casing word BPE vocabulary.

That tokenizer drops white space and never merges across it, so a text's ids
are the ids of its blank-separated chunks in order. Each batch is split and
dictionary-encoded by Arrow, and only chunks not seen before are tokenized.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words, and chunks as they are written, that a worker remembers; when full, a
# memory starts anew.
CACHE_WORDS = 400_000
CACHE_CHUNKS = 400_000
ASCII_MARKS = '!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~'


class WordIds:
    """ids(texts) -> (uint32 ids of all texts, offsets of each text)."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers
        self.whole = Tokenizer.from_file(path)
        self.plain = Tokenizer.from_file(path)  # for lower-case words of Latin-1 letters or marks
        self.plain.normalizer = normalizers.Sequence([])
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.whole.get_vocab()
        self.ends_word = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends_word[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.seen: dict[str, bytes] = {}

    def _learn(self, words: list[str]) -> None:
        if not words:
            return
        ids = np.array(self.plain.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, dtype="<u4")
        ends = (4 * (np.flatnonzero(self.ends_word[ids]) + 1)).tolist()
        raw, start = ids.tobytes(), 0
        for word, end in zip(words, ends, strict=True):
            self.words[word] = raw[start:end]
            start = end

    def _chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.seen) > CACHE_CHUNKS:
            self.seen = {}
        out = list(map(self.seen.get, chunks))
        new = [i for i, r in enumerate(out) if r is None]
        for i, r in zip(new, self._new_chunks([chunks[i] for i in new])):
            out[i] = self.seen[chunks[i]] = r
        return out

    def _new_chunks(self, chunks: list[str]) -> list[bytes]:
        if len(self.words) > CACHE_WORDS:
            self.words = {"": b""}
        known, split, new, odd = self.words, [], {}, {}
        for i, c in enumerate(chunks):
            w = c.rstrip(ASCII_MARKS)
            if not w or w.isalpha() and max(w) <= "\xff":
                w, mark = w.lower(), c[len(w):]
                if w not in known:
                    new[w] = None
                if mark not in known:
                    new[mark] = None
                split.append((w, mark))
            else:
                odd[i] = c
                split.append(("", ""))
        self._learn(list(new))
        out = [known[w] + known[m] if m else known[w] for w, m in split]
        for i, e in zip(odd, self.whole.encode_batch_fast(list(odd.values()), add_special_tokens=False)):
            out[i] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def ids(self, texts: pa.Array):
        t = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), "\n", " ")
        lists = pc.split_pattern(t, " ")
        flat = pc.dictionary_encode(lists.flatten())
        which = flat.indices.to_numpy()
        raw = self._chunks(flat.dictionary.to_pylist())
        size = np.array([len(r) // 4 for r in raw], dtype=np.int64)
        start = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(raw), dtype="<u4")
        n = size[which]
        done = np.concatenate(([0], np.cumsum(n)))
        at = np.arange(int(done[-1]), dtype=np.int64) + np.repeat(start[which] - done[:-1], n)
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        return pool[at], done[bounds]


_LOADED: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The tokenizer of this worker, with what it remembers from earlier tasks."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]
