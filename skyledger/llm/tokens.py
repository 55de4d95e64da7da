"""Whole texts to ids of a public byte-level BPE, through the tokenizers library.

A byte-level BPE first cuts a text into runs of letters, digits, other marks and
white space, and joins bytes within a run only. So each distinct unit between
such cuts is encoded once, and a worker keeps the units it has met, up to a
bound. Texts with white space beyond blank, tab and line ends, or with the
string of a special token, go to the library whole.
"""

from __future__ import annotations

import re

import numpy as np

_LATIN, _MARKS, _GAP = "A-Za-zÀ-ÖØ-öø-ÿ", re.escape(".,!?;:$%&*#|<>"), " \n\t\r"
#: Words of Latin letters, marks after them, other visible runs; then white space, of which
#: a last blank goes with what follows.
UNIT = re.compile(
    f" ?[{_LATIN}]+(?![^{_GAP}{_MARKS}])|[{_MARKS}]+(?![^{_GAP}])| ?[^{_GAP}]+|[{_GAP}]+(?![^{_GAP}])|[{_GAP}]"
)
#: Units that are one run of letters, which the model can take as they are.
_PLAIN = re.compile(f" ?[{_LATIN}]+")
#: A blank beside other white space.
_GAPS = tuple({f" {c}" for c in _GAP} | {f"{c} " for c in _GAP})
#: White space of Unicode that UNIT does not cut at.
OTHER_WHITE = "\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B)))
#: Most units a worker keeps, and most pieces between blanks.
KEPT_UNITS, KEPT_PIECES = 800_000, 700_000

_encoders: dict[str, Encoder] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str | None = None) -> Encoder:
    """The worker's encoder of this file; units met in earlier tasks are known already."""
    path = path or default_path()
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str, kept_units: int = KEPT_UNITS, kept_pieces: int = KEPT_PIECES) -> None:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_file(path)
        self.model = Tokenizer(self.library.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        # A byte-level model writes visible bytes as themselves and the others from 256 on.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        self.letters = {b: chr(b) for b in own} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.letters[10] = f" {self.letters[10]} "
        self.kind = np.dtype("<u2" if self.library.get_vocab_size() <= 1 << 16 else "<u4")
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.known: dict[str, bytes] = {}  # pieces after a blank
        self.units: dict[str, bytes] = {}
        self.kept_units, self.kept_pieces = kept_units, kept_pieces
        line_end = self._encode(["\n"])[0]
        self.line_end = np.frombuffer(line_end, self.kind)[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in found]

    def _units(self, units: list[str]) -> dict[str, bytes]:
        """Encode units in one text, a line end after each; those with line ends one by one.

        Single words skip the library's search for runs: the model gets their
        bytes in its own letters, set apart by blanks.
        """
        rest = [u for u in units if not u.strip(" \n\t\r")]
        found = dict(zip(rest, self._encode(rest), strict=True))
        for plain in (True, False):
            some = [u for u in units if bool(_PLAIN.fullmatch(u)) == plain and u.strip(" \n\t\r")]
            if not some:
                continue
            text = "\n".join(some)
            if plain:
                text = text.encode().decode("latin-1").translate(self.letters)
                ids = np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.kind)
            else:
                ids = np.frombuffer(self._encode([text])[0], self.kind)
            ends = np.append(np.flatnonzero(ids == self.line_end), len(ids)) * self.kind.itemsize
            raw, start = ids.tobytes(), 0
            for unit, end in zip(some, ends.tolist(), strict=True):
                found[unit] = raw[start:end]
                start = end + self.kind.itemsize
        return found

    def whole(self, text: str) -> bool:
        """Whether this text must not be cut."""
        if not text.isascii() and any(c in text for c in OTHER_WHITE):
            return True
        return any(c in text for c in OTHER_WHITE[:6]) or any(s in text for s in self.special)

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Pieces that stand after a blank, through their units."""
        cut = {p: UNIT.findall(f" {p}") for p in pieces}
        own = {u: self.units.get(u) for units in cut.values() for u in units}
        new = self._units([u for u, x in own.items() if x is None])
        own |= new
        if len(self.units) + len(new) <= self.kept_units:
            self.units.update(new)
        return {p: b"".join([own[u] for u in units]) for p, units in cut.items()}

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text as an array of ``kind``; null texts are empty."""
        known, out = self.known, []
        for text in texts:
            if not text:
                out.append(b"")
            elif self.whole(text):
                out.append(self._encode([text])[0])
            else:
                head, *pieces = text.split(" ")
                if not head or not pieces or not pieces[-1] or any(g in text for g in _GAPS):  # cut by units only
                    units = UNIT.findall(text)
                    own = {u: self.units.get(u) for u in units}
                    own |= self._units([u for u, x in own.items() if x is None])
                    out.append(b"".join([own[u] for u in units]))
                    continue
                first = b"".join(self._units([u]).get(u, b"") if u not in self.units else self.units[u] for u in UNIT.findall(head))
                try:
                    out.append(first + b"".join([known[p] for p in pieces]))
                except KeyError:
                    own = self._pieces(list({p for p in pieces if p not in known}))
                    if len(known) + len(own) <= self.kept_pieces:
                        known.update(own)
                        out.append(first + b"".join([known[p] for p in pieces]))
                    else:
                        out.append(first + b"".join([known[p] if p in known else own[p] for p in pieces]))
        return [np.frombuffer(x, self.kind) for x in out]
