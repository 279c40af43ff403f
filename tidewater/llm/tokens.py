"""Token ids of whole texts by a tokenizer file, with a cache of encoded words in each Python worker."""

from __future__ import annotations

import re
from array import array
from collections.abc import Callable
from itertools import batched

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Encoded words in each of two caches of a worker.
CACHED_WORDS = 350_000
#: Words that are encoded as one text.
TOGETHER = 2000
_SPACED = re.compile(r"\s\s")
_WHITE = re.compile(r"\s")
_encoders: dict[str, Encoder] = {}


def marked(tokenizer, mark: Callable[[str], bool]) -> np.ndarray:
    """For each id whether its token has ``mark``."""
    out = np.zeros(tokenizer.get_vocab_size(), bool)
    out[[i for token, i in tokenizer.get_vocab().items() if mark(token)]] = True
    return out


def apart(tokenizer, words: list[str]) -> list[bytes]:
    return [array("I", e.ids).tobytes() for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]


def together(tokenizer, words: list[str], between: str, marks: np.ndarray, last: bool) -> list[bytes]:
    """The ids of each of ``words``, encoded many in a text, which saves most of the work of short ones.

    ``marks`` has the ids that only stand at the start, or the end if ``last``, of a word. A text whose marks are not as
    many as its words has its words encoded apart.
    """
    groups = [list(g) for g in batched(words, TOGETHER)]
    out: list[bytes] = []
    for group, e in zip(groups, tokenizer.encode_batch_fast(list(map(between.join, groups)), add_special_tokens=False),
                        strict=True):
        ids = np.array(e.ids, "<u4")
        cuts = np.flatnonzero(marks[ids]) + last
        if len(cuts) != len(group) or (cuts[-1] != len(ids) if last else cuts[0] != 0):
            out += apart(tokenizer, group)
            continue
        raw, ends = ids.tobytes(), (4 * (np.append(0, cuts) if last else np.append(cuts, len(ids)))).tolist()
        out += [raw[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
    return out


def laid_out(own: list[bytes], codes: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    """The ids of texts: those of the words ``codes``, numbers in ``own``, from each of ``offsets`` to the next."""
    sizes = np.fromiter(map(len, own), np.int64, len(own)) // 4
    flat, counts = np.frombuffer(b"".join(own), "<u4"), sizes[codes]
    ends = np.append(0, np.cumsum(counts))
    ids = flat[np.arange(ends[-1]) + np.repeat((np.cumsum(sizes) - sizes)[codes] - ends[:-1], counts)].tobytes()
    places = (4 * ends[offsets]).tolist()
    return [ids[a:b] for a, b in zip(places[:-1], places[1:], strict=True)]


class Encoder:
    """Ids as packed little-endian unsigned 32-bit numbers.

    A byte-level BPE never joins what stands before a single space with what follows. So a text without two white space
    characters in a row is cut at its spaces and each word is encoded once; other texts are encoded in one piece. Arrow cuts
    the texts and numbers their words, so that each is looked up once. New words without other white space are encoded many
    in a text: only a word's first token starts with a space. A comma or full stop that ends a word behind a letter is a token
    of its own, so such a word is looked up without it.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.signs = dict(zip(",.", apart(self.tokenizer, [",", "."]), strict=True))
        self.starts = marked(self.tokenizer, lambda token: token.startswith("Ġ"))

    def _learn(self, words: list[str]) -> None:
        """``words`` behind a space are known after it."""
        odd = [w for w in words if not w or _WHITE.search(w) or "<" in w]
        plain = list(set(words).difference(odd))
        spaced = [" " + w for w in plain]
        self.known.update(zip(plain, together(self.tokenizer, spaced, "", self.starts, False), strict=True))
        self.known.update(zip(odd, apart(self.tokenizer, [" " + w for w in odd]), strict=True))

    def _cut(self, texts: list[str]) -> list[bytes]:
        cut = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        coded, offsets = cut.values.dictionary_encode(), cut.offsets.to_numpy()
        codes, words = coded.indices.to_numpy().copy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        firsts = offsets[:-1]  # a text's first word has no space before it
        leading = apart(self.tokenizer, [words[k] for k in codes[firsts].tolist()])
        codes[firsts] = len(words) + np.arange(len(firsts))
        used = np.zeros(len(words) + len(firsts), bool)
        used[codes] = True  # not the words that only start texts
        return laid_out([*self._behind_spaces(words, used.tolist()), *leading], codes, offsets)

    def _behind_spaces(self, words: list[str], used: list[bool]) -> list[bytes]:
        """The ids of ``words``. A full cache is kept until the next one is full: words met again move there."""
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {}, self.known
        signs = [w[-1:] if w[-1:] in self.signs and "a" <= w[-2:-1].lower() <= "z" else "" for w in words]
        stems = [w[:-1] if sign else w for w, sign in zip(words, signs, strict=True)]
        known, older = self.known, self.older
        new = {w for w, u in zip(stems, used, strict=False) if u and w not in known}
        known.update((w, older[w]) for w in new if w in older)
        self._learn([w for w in new if w not in known])
        return [(known[w] + self.signs[sign] if sign else known[w]) if u else b""
                for w, sign, u in zip(stems, signs, used, strict=False)]

    def batch(self, texts: list[str]) -> list[bytes]:
        whole = [bool(_SPACED.search(text)) for text in texts]
        cut = iter(self._cut([text for text, w in zip(texts, whole, strict=True) if not w]) if not all(whole) else [])
        one = iter(apart(self.tokenizer, [text for text, w in zip(texts, whole, strict=True) if w]))
        return [next(one if w else cut) for w in whole]


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
