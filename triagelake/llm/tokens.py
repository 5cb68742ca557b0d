"""Token ids of texts by a given tokenizer file, with the ids of each word kept for the next time."""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

_PLAIN = re.compile("[a-zà-öø-ÿ]+")
#: Kinds of bytes: white space that the tokenizer drops, letters (those of Latin-1 are two bytes), digits, marks that it
#: always cuts off from letters and digits, and anything else: an apostrophe (contractions), other letters, marks that
#: combine.
_GAP, _LETTER, _DIGIT, _MARK, _OTHER = range(5)


def _kinds() -> np.ndarray:
    kinds = np.full(256, _OTHER, dtype=np.uint8)
    kinds[list(b" \n\t\r")] = _GAP
    kinds[[x for x in range(33, 127) if not chr(x).isalnum() and chr(x) != "'"]] = _MARK
    kinds[list(b"0123456789")] = _DIGIT
    kinds[[*range(ord("a"), ord("z") + 1), *range(ord("A"), ord("Z") + 1)]] = _LETTER
    return kinds


_KINDS = _kinds()


#: Bytes of known parts, about, and what an entry takes besides its text and ids. Parts that were not met while half of
#: that came in are forgotten.
KEPT, ENTRY = 448 << 20, 300
#: Bytes of text that are cut and encoded in one call; a longer text is a call of its own.
AT_ONCE = 4_000_000


class Encoder:
    """Ids as `tokenizer.encode(text, add_special_tokens=False)` gives them.

    The tokenizer lower-cases, drops white space and cuts between letters, digits and marks, so a text's
    ids are its parts' ids one after the other. Unknown parts of many texts are encoded in one call, as
    one text; tokens that end a word show where one part's ids end. Words with any other character are
    encoded one by one, as they are. White space is a part without ids.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.size = 0

    def one(self, text: str) -> bytes:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids
        return np.asarray(got, dtype="<u4").tobytes()

    def learn(self, parts: set[str]) -> None:
        """Store the ids of parts that are not known yet."""
        new = parts.difference(self.known)
        self.size += sum(map(len, new)) * 3 + ENTRY * len(new)
        if self.size > KEPT // 2:
            self.earlier, self.known, self.size, new = self.known, {}, 0, parts
        if self.earlier:
            again = new.intersection(self.earlier)
            self.known.update((x, self.earlier[x]) for x in again)
            new = new.difference(again)
        simple = [x for x in new if x.isascii() and x.isalpha() and x.islower()]
        # The model alone does for a-z: there is nothing to normalize and no byte to rename.
        tokenize = self.model.tokenize
        for x in simple:
            self.known[x] = array("I", [t.id for t in tokenize(x)]).tobytes()
        plain = [x for x in new.difference(simple) if _PLAIN.fullmatch(x)]
        if plain:
            ids = np.asarray(
                self.tokenizer.encode_batch_fast([" ".join(plain)], add_special_tokens=False)[0].ids, dtype="<u4"
            )
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * 4).tolist()
            if len(stops) == len(plain):
                raw = ids.tobytes()
                self.known.update(zip(plain, map(raw.__getitem__, map(slice, [0, *stops], stops)), strict=True))
            else:  # a tokenizer that cuts words otherwise
                self.known.update((x, self.one(x)) for x in plain)
        self.known.update((x, self.one(x)) for x in new.difference(simple, plain))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """All ids of each text as little-endian unsigned 32-bit integers; null as an empty text."""
        held, size = [], 0
        for text in texts:
            held.append((text or "").encode())
            size += len(held[-1])
            if size >= AT_ONCE:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, texts: list[bytes]) -> Iterator[bytes]:
        """All texts are cut at once; each different part is looked up once, and its ids put wherever it stands."""
        raw = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
        if not len(raw):
            yield from (b"" for _ in texts)
            return
        data, cuts = _cut(raw)
        offsets = np.append(cuts, len(raw)).astype(np.int32)
        parts = pa.StringArray.from_buffers(len(cuts), pa.py_buffer(offsets), pa.py_buffer(data)).dictionary_encode()
        different, place = parts.dictionary.to_pylist(), parts.indices.to_numpy()
        got = list(map(self.known.get, different))
        unknown = {different[i] for i, x in enumerate(got) if x is None}
        if unknown:
            self.learn(unknown)
            got = list(map(self.known.__getitem__, different))
        ids = np.frombuffer(b"".join(got), dtype="<u4")
        lengths = np.fromiter(map(len, got), dtype=np.int64, count=len(got)) // 4
        begins = np.cumsum(lengths) - lengths
        many = lengths[place]
        ends = np.cumsum(many)
        whole = ids[np.repeat(begins[place] - (ends - many), many) + np.arange(ends[-1])].tobytes()
        # A text's parts end at the gap that follows it, which has no ids, so its end need not be a cut.
        stops = np.cumsum([len(x) + 1 for x in texts]) - 1
        done = np.append(0, ends)[np.searchsorted(cuts, stops, side="left")].tolist()
        yield from (whole[4 * x:4 * y] for x, y in zip([0, *done], done, strict=False))


def _cut(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes in lower case, and where they are to be cut: between white space, runs of letters or marks, single digits.

    Words (between white space) with any other character stay in one piece and as they are, and so do those with the
    opening of a special token.
    """
    kinds, follows = _KINDS[raw], np.append(raw[1:], 0)
    data = raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * 32
    lead = np.flatnonzero((raw == 0xC3) & (follows >= 0x80) & (follows <= 0xBF) & (follows != 0x97) & (follows != 0xB7))
    kinds[lead] = kinds[lead + 1] = _LETTER
    data[lead + 1] += (raw[lead + 1] <= 0x9E).astype(np.uint8) * 32
    # ß has no capital among these, 0x9F is its own; 0xB8 and above are small letters already.
    kinds[(raw == 60) & (follows == 124)] = _OTHER
    before = np.append(np.uint8(_GAP), kinds[:-1])
    cut = (kinds != before) | (kinds == _DIGIT)
    odd = np.flatnonzero(kinds == _OTHER)
    if len(odd):
        gap = kinds == _GAP
        edges = np.flatnonzero(gap != np.append(True, gap[:-1]))  # words begin and end here, in turns
        word = np.unique(np.searchsorted(edges, odd, side="right") - 1)
        begin = edges[word]
        end = np.append(edges, len(raw))[word + 1]
        inside = np.zeros(len(raw) + 1, dtype=np.int8)
        inside[begin] += 1
        inside[end] -= 1
        inside = np.cumsum(inside[:-1], dtype=np.int8).astype(bool)
        cut &= ~inside
        cut[begin] = True
        data = np.where(inside, raw, data)
    cut[0] = True
    return data, np.flatnonzero(cut)


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
