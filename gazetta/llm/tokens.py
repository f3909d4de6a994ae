"""Token ids of whole texts with the tokenizers library, one encoding per distinct word.

A BPE tokenizer never merges over a pre-token's edge. Texts whose white space is single blanks and single line feeds are
cut before each of them and before punctuation that follows a letter, each distinct word is encoded once per worker, and a document's ids are its words' ids in order:
a batch is cut and numbered by Arrow, and its ids are gathered from one array. A new word of Latin letters is one pre-token and
goes to the tokenizer's model as it is, where the tokenizer spells bytes as one character each. Other new words are encoded many at
a time, as one text of their own that is cut in the same places. Other texts are encoded whole.
"""

from __future__ import annotations

import itertools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gazetta.llm.common import resident

#: White space other than single blanks and line feeds, and the sign that marks a cut without white space.
_OTHER_SPACE = r"[\x01\t\v\f\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]|[ \n][ \n]"
#: A pre-token of letters or digits ends before punctuation; letters are Latin ones.
_BEFORE_SIGN = r"([0-9A-Za-zÀ-ÖØ-öø-įı-ɏ])([.,;:!?#$%&*])"
#: Words remembered per worker; beyond it the memory starts anew.
REMEMBERED = 500_000
#: Characters of new words that are encoded as one text.
_TOGETHER = 1 << 16
#: Words of letters that normalising leaves as they are, but for their case; behind a blank or a line feed.
_LETTERS = re.compile("\n?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch
#: Characters that spell the bytes of such letters in byte-level tokenizers: their own, or others for bytes that are no printable Latin-1.
_SPELLED = np.arange(256, dtype="<u2")
_SPELLED[0x80:0xA1] += 162
_SPELLED[0xAD] = 323


def _strings(column: pa.Array) -> list[str]:
    """As ``to_pylist``, without an Arrow scalar for each."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Ids of texts, put together from those of their distinct words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        pieces, norm = [], self.tokenizer.normalizer
        if self.tokenizer.pre_tokenizer:
            pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(norm.normalize_str(" Aé") if norm else " Aé")
        #: What a word behind a blank begins with and whether it is put in lower case; None where words are not spelled byte by byte.
        spellings = {"AÃ©": ("", False), "aÃ©": ("", True), "ĠAÃ©": ("Ġ", False), "ĠaÃ©": ("Ġ", True)}
        self.spelling = spellings.get(pieces[0][0]) if len(pieces) == 1 else None
        self.line_feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        #: Numbers of keys; the ids of key n stand in ``held`` from ``ends[n]`` to ``ends[n + 1]``.
        self.place: dict[str, int] = {}
        self.held, self.ends = np.zeros(1 << 16, np.uint32), np.zeros(1, np.int64)

    def _remember(self, keys: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, start = len(self.place), int(self.ends[-1])
        self.place.update(zip(keys, range(n, n + len(keys)), strict=True))
        self.ends = np.concatenate([self.ends, start + np.cumsum(sizes)])
        if len(self.held) < self.ends[-1]:
            self.held = np.concatenate([self.held, np.zeros(max(len(self.held), len(ids)), np.uint32)])
        self.held[start : start + len(ids)] = ids

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are encoded one by one, and how many each has."""
        coded = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.fromiter(map(len, coded), np.int64, len(coded))
        return np.fromiter((i for ids in coded for i in ids), np.uint32, int(sizes.sum())), sizes

    def _learn_letters(self, words: list[str]) -> None:
        """Remember words of letters: each is one pre-token, with its blank, or stands by itself behind the ids of a line feed."""
        if not words:
            return
        blank, lower = self.spelling
        joined = " ".join(words).replace("\n", "")
        data = np.frombuffer((joined.lower() if lower else joined).encode(), np.uint8)
        spelled = _SPELLED[data].tobytes().decode("utf-16-le").split(" ")
        ids: list[int] = []
        edges = [0]
        tokenize, line_feed = self.model.tokenize, self.line_feed
        for word, own in zip(words, spelled, strict=True):
            if word[0] == "\n":
                ids += line_feed
            else:
                own = blank + own
            ids += [token.id for token in tokenize(own)]
            edges.append(len(ids))
        self._remember(words, np.array(ids, np.uint32), np.diff(edges))

    def _learn(self, words: list[str]) -> None:
        """Remember words by what they give behind other words: each with its blank or line feed in front, signs without."""
        if self.spelling:
            of_letters = [_LETTERS(w) is not None for w in words]
            self._learn_letters(list(itertools.compress(words, of_letters)))
            words = [w for w, own in zip(words, of_letters, strict=True) if not own]
        alone = [w for w in words if w in ("", "\n") or w[0] == "\x01"]
        if alone:
            self._remember(alone, *self._whole([w.removeprefix("\x01") or " " for w in alone]))
        words, at = [w for w in words if w not in ("", "\n") and w[0] != "\x01"], 0
        while at < len(words):
            parts, size = [], 0
            while at < len(words) and (not parts or size + len(words[at]) < _TOGETHER):
                parts.append(words[at] if words[at][0] == "\n" else f" {words[at]}")
                size += len(parts[-1])
                at += 1
            coded = self.tokenizer.encode("".join(parts), add_special_tokens=False)
            starts = np.fromiter((a for a, _ in coded.offsets), np.int64, len(coded.ids))
            edges = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)))
            sizes = np.bincount(np.searchsorted(edges, starts, "right"), minlength=len(parts))
            self._remember(words[at - len(parts) : at], np.array(coded.ids, np.uint32), sizes)

    def _places(self, words: list[str], heads: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words, and of heads of texts; unknown ones are learnt first."""
        if len(self.place) > REMEMBERED:
            self._forget()
        place = self.place
        found = np.fromiter(map(place.get, words, itertools.repeat(-1)), np.int64, len(words))
        missing = np.flatnonzero(found < 0)
        new = [words[i] for i in missing.tolist()]
        self._learn(new)
        found[missing] = np.fromiter(map(place.__getitem__, new), np.int64, len(new))
        # what stands before the first blank has no blank of its own; no other key holds two line feeds
        keys = [f"\n\n{h}" for h in heads]
        unknown = {k: h for k, h in zip(keys, heads, strict=True) if k not in place}
        if unknown:
            self._remember(list(unknown), *self._whole(list(unknown.values())))
        return found, np.fromiter(map(place.__getitem__, keys), np.int64, len(keys))

    def _even(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts that are cut at single blanks, and how many each has."""
        signs = pc.replace_substring_regex(pc.replace_substring(text, "\n", " \n"), _BEFORE_SIGN, "\\1 \x01\\2")
        cut = pc.split_pattern(signs, " ")
        first = cut.offsets.to_numpy()
        words = pc.dictionary_encode(cut.flatten())
        is_head = np.zeros(len(words), bool)
        is_head[first[:-1] - first[0]] = True
        codes = words.indices.to_numpy(zero_copy_only=False)
        # a word that only heads a text is not to be learnt as one behind a blank
        used = np.zeros(len(words.dictionary), bool)
        used[codes[~is_head]] = True
        found, heads = self._places(_strings(words.dictionary.filter(pa.array(used))), _strings(words.dictionary.take(pa.array(codes[is_head]))))
        start_of, size_of = np.zeros((2, len(used)), np.int64)
        start_of[used], size_of[used] = self.ends[found], self.ends[found + 1] - self.ends[found]
        starts, sizes = start_of[codes], size_of[codes]
        starts[is_head], sizes[is_head] = self.ends[heads], self.ends[heads + 1] - self.ends[heads]
        before = np.cumsum(sizes) - sizes
        ids = self.held[np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))]
        return ids, np.add.reduceat(sizes, first[:-1] - first[0])

    def encode(self, texts: list[str], end: int | None = None) -> list[bytes]:
        """Ids of each text, as little-endian unsigned 32-bit bytes."""
        if not texts:
            return []
        ids, edges = self.encode_column(pa.array(texts, pa.large_string()), end)
        return [part.astype("<u4").tobytes() for part in np.split(ids, edges[1:-1])]

    def encode_column(self, column: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, each with the id ``end`` behind it if given, and the edges between texts. NULL is empty."""
        text = pc.fill_null(column.cast(pa.large_string()), "")
        odd = pc.match_substring_regex(text, _OTHER_SPACE).to_numpy(zero_copy_only=False)
        more = end is not None
        counts = np.zeros(len(text), np.int64)
        even_ids = odd_ids = np.zeros(0, np.uint32)
        if not odd.all():
            even_ids, counts[~odd] = self._even(text.filter(pa.array(~odd)))
        if odd.any():
            odd_ids, counts[odd] = self._whole(text.filter(pa.array(odd)).to_pylist())
        edges = np.concatenate([[0], np.cumsum(counts + more)])
        ids = np.zeros(int(edges[-1]), np.uint32)
        inner = np.ones(len(ids), bool)
        if more:
            inner[edges[1:] - 1] = False
            ids[~inner] = end
        if odd.any():
            whole = np.repeat(odd, counts + more)
            ids[inner & ~whole] = even_ids
            ids[inner & whole] = odd_ids
        else:
            ids[inner] = even_ids
        return ids, edges


def encoder(path: str) -> Encoder:
    """One per worker and file."""
    return resident(("tokens", path), lambda: Encoder(path))
