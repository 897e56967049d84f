"""Token ids of whole texts by a public tokenizer file, with a word cache.

The tokenizer drops white space and never joins across it, so the ids of a text
are those of its white-space separated chunks in turn.  A batch of texts is cut
into chunks, the distinct chunks are looked up or encoded, and their ids are
gathered back, all as Arrow arrays.
"""

from __future__ import annotations

import re
import sys
from itertools import accumulate
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from vidtrend.llm.common import WORKER_STATE

#: Characters whose normalized form keeps its place.
PLAIN = re.compile(r"[!-~¡-įı-ɏ]+").fullmatch
JOINED = 256
#: Distinct chunks kept from task to task; those met when it is full are kept for a batch.
CACHE = 350_000


def shared_encoder(path: str) -> "ChunkEncoder":
    """The encoder of this Python worker, which Spark keeps for many tasks."""
    state = sys.modules.setdefault(WORKER_STATE, ModuleType(WORKER_STATE))
    encoders = vars(state).setdefault("encoders", {})
    if path not in encoders:
        encoders[path] = ChunkEncoder(path)
    return encoders[path]


class ChunkEncoder:
    """encode(texts) -> ids of each as bytes of ``dtype``; ``path`` is the tokenizer's JSON file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.dtype = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.known: dict[str, bytes] = {"": b""}
        self.marks = {m: self.coded(self.tokenizer.encode(m, add_special_tokens=False).ids) for m in ".,"}

    def learn(self, chunks: list[str]) -> list[str]:
        """Make every chunk known; returns the words added besides them."""
        known = self.known
        # letters with a stop or comma: the ids of the lower-case letters, then of the mark
        ended, bare, rest = [], [], []
        for c in chunks:
            if not (c.isascii() or PLAIN(c)):
                rest.append(c)
            elif c.isalpha():
                bare.append((c, c.lower()))
            elif c[-1] in self.marks and c[:-1].isalpha():
                ended.append((c, c[:-1].lower(), c[-1]))
            else:
                rest.append(c)
        words = list({w for _, w, _ in ended}.union([w for _, w in bare]).difference(known))
        self.encode_words(words)
        for c, w in bare:
            known[c] = known[w]
        for c, w, m in ended:
            known[c] = known[w] + self.marks[m]
        self.encode_words([c for c in rest if PLAIN(c)])
        rest = [c for c in rest if c not in known]
        for c, enc in zip(rest, self.tokenizer.encode_batch(rest, add_special_tokens=False)):
            known[c] = self.coded(enc.ids)
        return words

    def encode_words(self, words: list[str]) -> None:
        """Many words in one call; the place of each id in the joined text tells its word."""
        width = self.dtype.itemsize
        for k in range(0, len(words), JOINED):
            part = words[k:k + JOINED]
            enc = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            first = [0, *accumulate(len(c) + 1 for c in part)]
            at = (np.searchsorted([o[0] for o in enc.offsets], first) * width).tolist()
            ids = self.coded(enc.ids)
            self.known.update((c, ids[a:b]) for c, a, b in zip(part, at, at[1:]))

    def coded(self, ids: list[int]) -> bytes:
        return np.array(ids, dtype=self.dtype).tobytes()

    def encode(self, texts: pa.Array, end: list[int]) -> pa.Array:
        """The ids of each text, followed by ``end``, as a binary array; null is the empty text."""
        known, last = self.known, self.coded(end)
        lists = pc.ascii_split_whitespace(texts.cast(pa.string()).fill_null(""))
        encoded = lists.flatten().dictionary_encode()
        distinct = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(known.get, distinct))
        new = [c for c, found in zip(distinct, ids) if found is None]
        if new:
            words = self.learn(new)
            ids = [known[c] if found is None else found for c, found in zip(distinct, ids)]
            if len(known) > CACHE:
                for c in set(new).union(words):
                    del known[c]
        # the end follows the last chunk of each text
        stops = np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))
        codes = np.insert(encoded.indices.to_numpy(zero_copy_only=False), stops, len(ids))
        gathered = pa.array([*ids, last], pa.binary()).take(pa.array(codes))
        _, offsets, data = gathered.buffers()
        at = np.frombuffer(offsets, np.int32)[np.concatenate(([0], stops + np.arange(1, len(stops) + 1)))]
        return pa.BinaryArray.from_buffers(pa.binary(), len(texts), [None, pa.py_buffer(at.tobytes()), data])
