"""Pre-tokens of the byte-level vocabulary, and their ids from the `tokenizers` library.

The library cuts a text into pre-tokens and merges within each one alone. So a text's ids are those of its
pre-tokens in turn, and a pre-token needs the library only once. New pre-tokens of letters go to the library
joined into one text, from which it cuts the same pre-tokens again. A space that follows no other white space
always starts a pre-token, so ids are kept for whole stretches between spaces too. Texts with characters whose class differs
between the engines' Unicode tables, and texts that hold a special string, go through the library whole.
"""

from __future__ import annotations

import array
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: The pre-token pattern of the vocabulary, for texts of plain() characters.
#: ²³¹¼½¾ are numbers in Unicode, but word characters and no digits in Python's re.
SPLIT = re.compile(r"'(?:s|t|re|ve|m|ll|d)| ?[^\W\d_²³¹¼½¾]+| ?[\d²³¹¼½¾]+| ?(?:[^\w\s]|_)+|\s+(?!\S)|\s+")
#: Anything but Latin letters, ASCII but \x1c-\x1f, and common punctuation.
ODD = re.compile("[^\x00-\x1b\x20-ɏ‐-‧‰-⁞€]")
#: The same as ODD, and white space before a space (without it, every space starts a pre-token), for Arrow.
ODD_RE2 = r"[^\x00-\x1b\x20-\x{24f}\x{2010}-\x{2027}\x{2030}-\x{205e}\x{20ac}]"
RUN_RE2 = r"[\t-\r \x{85}\x{a0}] "
#: Marks the stretch that a text begins with; plain() texts have no such character.
HEAD = "\x1e"


class PreTokens:
    """Splitter and cached encoder over a tokenizers file; one per Python worker."""

    #: Entries of a generation; two are kept, and one that is full becomes the old one.
    KEEP = 250_000
    #: Bytes of the texts that are encoded together.
    TOGETHER = 12 << 20

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.lib = Tokenizer.from_file(path)
        if hasattr(self.lib.model, "_resize_cache"):
            self.lib.model._resize_cache(0)  # its own cache of words only costs: what is kept is kept here
        (self.feed,) = self.lib.encode("\n", add_special_tokens=False).ids
        self.specials = [t.content for t in self.lib.get_added_tokens_decoder().values()]
        self.apart = "|".join([ODD_RE2, RUN_RE2, *(re.sub(r"(\W)", r"\\\1", x) for x in self.specials)])
        # Raw ids of stretches (without the space they begin with), and of pieces that have no space.
        self.spaced: dict[str, bytes] = {}
        self.bare: dict[str, bytes] = {}
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = {}, {}

    def plain(self, text: str) -> bool:
        if any(x in text for x in self.specials):
            return False
        if text.isascii():
            return not any(c in text for c in "\x1c\x1d\x1e\x1f")
        return not ODD.search(text)

    def whole(self, text: str) -> list[int]:
        """Ids as the library gives them for the text."""
        return self.lib.encode(text, add_special_tokens=False).ids

    def split(self, text: str) -> list[str]:
        return SPLIT.findall(text)

    def counts(self, text: str) -> Counter:
        return Counter(SPLIT.findall(text))

    def encode_pieces(self, pieces: list[str]) -> list[bytes]:
        """Raw ids of each pre-token. Not for texts at large: a piece must be one that split() gave."""
        out: list[bytes] = [b""] * len(pieces)
        spaced, bare, alone = [], [], []
        for i, p in enumerate(pieces):
            (bare if p.isalpha() else spaced if p[0] == " " and p[1:].isalpha() else alone).append(i)
        for own in (spaced, bare):
            for i, raw in zip(own, self._joined([pieces[i] for i in own], ""), strict=True):
                out[i] = raw
        for i, e in zip(alone, self.lib.encode_batch([pieces[i] for i in alone], add_special_tokens=False), strict=True):
            out[i] = array.array("I", e.ids).tobytes()
        return out

    def _joined(self, letters: list[str], before: str):
        """Raw ids of pre-tokens of letters, with `before` in front of each.

        A line feed between two of them is a pre-token of its own, and its id is in no word.
        """
        for at in range(0, len(letters), 5000):
            text = before + f"\n{before}".join(letters[at : at + 5000])
            ids = np.array(self.lib.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
            cuts = 4 * np.flatnonzero(ids == self.feed)
            raw = ids.tobytes()
            yield from (raw[a:b] for a, b in zip([0, *(cuts + 4).tolist()], [*cuts.tolist(), len(raw)], strict=True))

    def column(self, texts: pa.Array):
        """Per text of a column all its ids, as an array of unsigned 32-bit numbers. Nulls are empty."""
        ends = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + self.TOGETHER, side="right")))
            yield from self._together(pc.fill_null(texts.slice(at, to - at), ""))
            at = to
        pa.default_memory_pool().release_unused()

    def ids(self, text: str) -> np.ndarray:
        return next(self.column(pa.array([text])))

    def _together(self, texts: pa.Array):
        if len(self.spaced) + len(self.bare) > self.KEEP:
            self.old, self.spaced, self.bare = (self.spaced, self.bare), {}, {}
        odd = pc.match_substring_regex(texts, self.apart)
        apart = {i: self._alone(texts[i].as_py()) for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False))}
        cut = pc.split_pattern(pc.binary_join_element_wise(HEAD, pc.if_else(odd, "", texts), ""), " ")
        words = cut.flatten().dictionary_encode()
        which = words.indices.to_numpy()
        raw = self._raw(words.dictionary.to_numpy(zero_copy_only=False).tolist())
        # A chunk has far fewer than 2 ** 31 tokens, unless one text alone is larger.
        kind = np.int32 if texts.nbytes < 1 << 30 else np.int64
        n = np.fromiter(map(len, raw), kind, len(raw)) >> 2
        flat, first = np.frombuffer(b"".join(raw), "<u4"), np.cumsum(n, dtype=kind) - n
        count = n[which]
        done = np.cumsum(count, dtype=kind)
        edge = np.concatenate([[0], done])[np.asarray(cut.offsets) - cut.offsets[0].as_py()]
        at = first[which]
        at -= done
        at += count
        at = np.repeat(at, count)
        at += np.arange(len(at), dtype=kind)
        ids = flat[at]
        del at, count, done
        for i in range(len(texts)):
            yield apart[i] if i in apart else ids[edge[i] : edge[i + 1]]

    def _alone(self, text: str) -> np.ndarray:
        if not self.plain(text):
            return np.array(self.whole(text), "<u4")
        pieces = SPLIT.findall(text)
        self._learn(set(pieces))
        return np.frombuffer(b"".join(map(self._of, pieces)), "<u4")

    def _of(self, piece: str) -> bytes:
        return self.spaced[piece[1:]] if piece[0] == " " else self.bare[piece]

    def _raw(self, stretches: list[str]) -> list[bytes]:
        """Raw ids of distinct stretches; heads of texts are marked, the others follow a space."""
        spaced, bare = self.spaced, self.bare
        out = list(map(spaced.get, stretches))
        words, pieces, ended, made = [], set(), [], []
        for i in [i for i, r in enumerate(out) if r is None]:
            s = stretches[i]
            if s.isalpha():
                words.append(i)
                continue
            base = s.rstrip(",.;:!?")
            if base.isalpha():  # the commonest: a word and marks behind it
                ended.append((i, base, s[len(base) :]))
            else:
                made.append((i, SPLIT.findall(s[1:] if s[:1] == HEAD else " " + s)))
        for _, m in made:
            pieces.update(m)
        pieces.update({m for _, _, m in ended})
        fresh = {b for _, b, _ in ended if b not in spaced}
        fresh.update(stretches[i] for i in words)
        self._learn(pieces, fresh)
        for i in words:
            out[i] = spaced[stretches[i]]
        for i, b, m in ended:
            out[i] = spaced[b] + bare[m]
        of = self._of
        for i, m in made:
            out[i] = b"".join(map(of, m))
        return out

    def _learn(self, pieces: set[str], words: set[str] = frozenset()) -> None:
        """Adds pre-tokens, and words of letters that follow a space, from the old generation or the library."""
        spaced, bare, (old_spaced, old_bare) = self.spaced, self.bare, self.old
        spaced.update([(w, old_spaced[w]) for w in words if w in old_spaced])
        fresh = [w for w in words if w not in spaced]
        spaced.update(zip(fresh, self._joined(fresh, " "), strict=True))
        fresh = []
        for p in pieces:
            to, old, key = (spaced, old_spaced, p[1:]) if p[0] == " " else (bare, old_bare, p)
            if key not in to:
                if key in old:
                    to[key] = old[key]
                else:
                    fresh.append(p)
        for p, raw in zip(fresh, self.encode_pieces(fresh), strict=True):
            if p[0] == " ":
                spaced[p[1:]] = raw
            else:
                bare[p] = raw


_made: dict[str, PreTokens] = {}


def shared(path: str) -> PreTokens:
    if path not in _made:
        _made[path] = PreTokens(path)
    return _made[path]
