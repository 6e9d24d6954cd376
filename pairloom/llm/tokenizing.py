"""Token ids of whole texts by the ``tokenizers`` library, faster than one call per text.

A text may be cut before every single space that a plain visible character follows: in the vocabularies used here a
space can only begin a piece of text, and added tokens are cut out first. So the ids of a text are the ids of its
cuts in a row. Cuts are made and numbered column-wise; each distinct cut is looked up once per batch, and the word in
it (Latin letters, apart from punctuation after it) is remembered between batches. Words not seen yet are encoded in
one call: each of them is exactly one piece for the model, so the ids tell where a word begins or ends.
"""

from __future__ import annotations

import gc
import json
import operator
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_SAFE = re.compile("(?=[ \n][!-~¡-ɏ])")
#: A space or line end that is not followed by a plain visible character: such texts are cut by ``_SAFE`` instead.
_OTHER = "[ \n]([^!-~¡-ɏ]|$)"
_PARTS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!#$%&()*+,./:;=>?@\[\]^_{|}~-]*)\Z")


class CutEncoder:
    """Ids as numpy arrays. Remembers at most ``limit`` words; the ids do not depend on it."""

    def __init__(self, path: str, limit: int = 600_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        #: Vocabularies with word ends mark the last id of a word, byte-level ones the first (by its space).
        self.ends = bool(model["model"].get("end_of_word_suffix"))
        suffix = model["model"].get("end_of_word_suffix")
        vocabulary = model["model"]["vocab"]
        self.edge = np.zeros(max([*vocabulary.values(), *(x["id"] for x in model["added_tokens"])]) + 1, bool)
        for token, number in vocabulary.items():
            self.edge[number] = token.endswith(suffix) if self.ends else token.startswith("Ġ")
        self.known: dict[str, bytes] = {}
        self.cuts: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {"": b""}
        self.limit = limit
        self.line_end = self.plain("\n")
        self.separator = np.frombuffer(self.line_end, np.uint32)

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32).tobytes()

    def _learn(self, words: list[str]) -> None:
        """Remember words, which begin with the space or line end before them (or none where that changes nothing)."""
        for start in range(0, len(words), 1000):
            some = words[start : start + 1000]
            by_line = not self.ends and some[0][0] == "\n"
            joined = " " + " ".join(some) if self.ends else "".join(some)
            ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            at = np.flatnonzero(ids == self.separator[0] if by_line else self.edge[ids])
            bounds = [0, *(at + 1).tolist()] if self.ends else [*at.tolist(), len(ids)]
            if len(bounds) != len(some) + 1:
                raise ValueError("a word is not one piece in this vocabulary")
            raw = ids.tobytes()
            for word, a, b in zip(some, bounds, bounds[1:]):
                self.known[word] = raw[4 * a : 4 * b]

    def _encode_cuts(self, cuts: list[str]) -> list[bytes]:
        """Ids of cuts that begin with a space or a line end."""
        out = list(map(self.cuts.get, cuts))
        if None not in out:
            return out
        tails, known = self.tails, self.known
        if len(tails) > 10_000:
            tails.clear()
            tails[""] = b""
        if len(known) + len(cuts) > self.limit:
            known.clear()
        answers: dict[str, bytes] = {}
        new, words, ends = [], [], []
        match, lower = _PARTS.match, self.ends
        for cut in dict.fromkeys(c for c, ids in zip(cuts, out) if ids is None):
            if m := match(cut, 1):
                word, tail = m.groups()
                new.append(cut)
                words.append(word.lower() if lower else cut[0] + word)
                ends.append(tail)
            else:
                answers[cut] = self.plain(cut)
        for tail in {*ends}.difference(tails):
            tails[tail] = self.plain(tail)
        unknown = [w for w in dict.fromkeys(words) if w not in known]
        for sort in (unknown,) if lower else ([w for w in unknown if w[0] == x] for x in " \n"):
            self._learn(sort)
        answers.update(zip(new, map(operator.add, map(known.__getitem__, words), map(tails.__getitem__, ends))))
        out = [answers[c] if ids is None else ids for c, ids in zip(cuts, out)]
        if len(self.cuts) > self.limit:
            self.cuts.clear()
        self.cuts.update(answers)
        return out

    def encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids in order, number of ids of each text). Null texts are empty.

        Strings by the hundred thousand are made here, none in a cycle: the collector would only look at them again.
        """
        collecting = gc.isenabled()
        gc.disable()
        try:
            return self._encode_all(texts)
        finally:
            if collecting:
                gc.enable()

    def _encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = np.flatnonzero(pc.match_substring_regex(texts, _OTHER).to_numpy(zero_copy_only=False)).tolist()
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        flat = lists.flatten()
        bounds = np.zeros(len(texts) + 1, np.int64)
        np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False), out=bounds[1:])
        coded = flat.dictionary_encode()
        which = coded.indices.to_numpy(zero_copy_only=False)
        # the first cut of a text follows no space, and texts with other spaces are cut in another way
        keep = np.ones(len(which), bool)
        keep[bounds[:-1]] = False
        for i in odd:
            keep[bounds[i] : bounds[i + 1]] = False
        needed = np.zeros(len(coded.dictionary), bool)
        needed[which[keep]] = True
        wanted = np.flatnonzero(needed)
        cuts = [c if c[:1] == "\n" else " " + c for c in coded.dictionary.take(pa.array(wanted)).to_pylist()]
        pool = self._encode_cuts(cuts)
        places = np.zeros(len(needed), np.int32)
        places[wanted] = np.arange(len(wanted))
        where = places[which]
        odd = set(odd)
        for i in range(len(texts)):
            first = bounds[i]
            where[first] = len(pool)
            if i in odd:
                head, *rest = _SAFE.split(texts[i].as_py())
                pool += [self.plain(head) + b"".join(self._encode_cuts(rest)), b""]
                where[first + 1 : bounds[i + 1]] = len(pool) - 1
            else:
                pool.append(self.plain(flat[first].as_py()))
        # a batch's ids are far fewer than 2**31, and half-sized numbers halve what the gathering takes
        counts = np.fromiter(map(len, pool), np.int32, len(pool)) // 4
        values = np.frombuffer(b"".join(pool), np.uint32)
        lengths = counts[where]
        ends = np.cumsum(lengths, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        first = np.cumsum(counts, dtype=np.int64) - counts
        at = np.repeat((first[where] - (ends - lengths)).astype(np.int32), lengths)
        at += np.arange(total, dtype=np.int32)
        return values[at], np.diff(np.concatenate([[0], ends])[bounds])


_ENCODERS: dict[str, CutEncoder] = {}


def encoder(path: str) -> CutEncoder:
    """One encoder per worker process and vocabulary."""
    if path not in _ENCODERS:
        _ENCODERS[path] = CutEncoder(path)
    return _ENCODERS[path]
