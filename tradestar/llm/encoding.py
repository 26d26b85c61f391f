"""Token ids of a batch of texts: pre-tokens by array operations, each different one encoded once.

The texts of a batch are set end to end as bytes; the place where each pre-token begins follows from
the classes of neighbouring characters (letter, number, other, space, other white
space), for two kinds of vocabulary: byte-level ones whose pre-tokens take a leading space,
and lower-casing ones with word ends that drop white space.  Arrow then numbers the different
pre-tokens, only those are looked up in the worker's memory or given to the vocabulary's model, and
the ids are gathered by number.

Characters beyond ``KNOWN`` and controls are left to the library: the stretch around one, between places
where no pre-token can reach across, goes to its ``encode`` as it is, so that its own
Unicode tables hold.  A text with the string of an added token goes there whole if ``added_tokens`` is
set; else that string is ordinary text.  Any other vocabulary gets whole texts.
"""

from __future__ import annotations

import re
from array import array

#: Letters, numbers and others below this code point are told apart here (two bytes of UTF-8 at most).
KNOWN = 0x250
#: Pre-tokens that a generation of a worker's memory holds, and the longest one kept (bytes).
KEPT = 160_000
LONGEST = 48
#: Bytes of text encoded at a time.
AT_ONCE = 3_000_000

LETTER, NUMBER, OTHER, SPACE, WHITE, STRANGE, BORDER = range(7)
_BORDER = b"\xff"


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself if it is printable, else one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _class(c: str) -> int:
    import regex

    if c in " ":
        return SPACE
    if c in "\t\n\x0b\x0c\r\x85\xa0":
        return WHITE
    if ord(c) < 32 or 127 <= ord(c) < 160:
        return STRANGE
    return LETTER if regex.match(r"\p{L}", c) else NUMBER if regex.match(r"\p{N}", c) else OTHER


class Remembered:
    """Ids by pre-token, in two generations: one in use moves on, the others go with the older generation."""

    def __init__(self):
        self.young, self.old = {}, {}

    def age(self) -> None:
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young

    def get(self, piece: bytes) -> bytes | None:
        found = self.young.get(piece)
        if found is None and (found := self.old.get(piece)) is not None:
            self.young[piece] = found
        return found


class PieceEncoder:
    """Ids of texts by the vocabulary file at ``path``, little-endian, 16 bits if the vocabulary fits, else 32."""

    def __new__(cls, path: str, added_tokens: bool = False):
        import sys
        from types import ModuleType

        # a worker process serves many tasks: an encoder and what it has learned stay in a module of its own
        kept = sys.modules.setdefault("_token_worker", ModuleType("_token_worker")).__dict__
        if (path, added_tokens) not in kept:
            made = super().__new__(cls)
            made._open(path, added_tokens)
            kept[path, added_tokens] = made
        return kept[path, added_tokens]

    def _open(self, path: str, added_tokens: bool) -> None:
        import numpy as np
        from tokenizers import Tokenizer, models

        self.tokenizer, self.memory = Tokenizer.from_file(path), Remembered()
        self.tokenizer.encode_special_tokens = not added_tokens  # True: their strings in a text are ordinary text
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if added_tokens else []
        self.dtype = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.code = "H" if self.dtype == "<u2" else "I"
        self.model = self.tokenizer.model
        self.style = self._style() if isinstance(self.model, models.BPE) else None
        self.letters = _byte_letters()
        points = [chr(c) for c in range(KNOWN)]
        classes = [_class(c) for c in points]
        lower = list(range(KNOWN))
        if self.style == "word":
            for i, c in enumerate(points):
                made = self.tokenizer.normalizer.normalize_str(c)
                if classes[i] in (LETTER, NUMBER, OTHER):
                    if len(made) == 1 and ord(made) < KNOWN and (i < 128) == (ord(made) < 128):
                        lower[i] = ord(made)
                    else:
                        classes[i] = STRANGE
        self.strange = re.compile("[^" + "".join(re.escape(c) for c, k in zip(points, classes) if k != STRANGE) + "]").search
        self.classes, self.lower = np.array(classes, np.uint8), np.array(lower, np.uint16)
        self.by_byte = np.full(256, STRANGE, np.uint8)
        self.by_byte[:128] = self.classes[:128]
        self.by_byte[0xFF] = BORDER

    def _style(self) -> str | None:
        """"spaced": byte-level with a leading space; "word": lower-cased with word ends; None: anything else."""
        import json

        made = json.loads(self.tokenizer.to_str())
        norm, pre = made["normalizer"], made["pre_tokenizer"] or {}
        if norm is None and pre.get("type") == "ByteLevel" and not pre["add_prefix_space"] and pre["use_regex"]:
            return "spaced"
        steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
        parts = pre.get("pretokenizers", [])
        # Fixed value: the pattern of pre-tokens that the word style follows.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
        if steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["pattern"] == {"Regex": pattern} and parts[0]["invert"] and not parts[1]["add_prefix_space"] and not parts[1]["use_regex"]:
            return "word"
        return None

    def _library(self, text: str) -> bytes:
        import numpy as np

        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: bytes) -> bytes:
        """Ids of a pre-token, or of a stretch with a strange character."""
        if piece == _BORDER:
            return b""
        text = piece.decode()
        plain = text.isascii() and text.isprintable()
        if not plain and self.strange(text):
            return self._library(text)
        if self.style == "word" and text.isspace():
            return b""
        letters = text.replace(" ", self.letters[32]) if plain else piece.decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.model.tokenize(letters)]).tobytes()

    def _cuts(self, a):
        """Bytes (lower-cased in the word style) and the places where a pre-token or a strange stretch begins."""
        import numpy as np

        c = self.by_byte[a]
        lead = np.flatnonzero((a >= 0xC2) & (a < 0xC0 + -(-KNOWN // 64)))
        point = ((a[lead] & 31).astype(np.uint16) << 6) | (a[lead + 1] & 63)
        inside = point < KNOWN
        lead, point = lead[inside], point[inside]
        c[lead] = c[lead + 1] = self.classes[point]
        p = np.append(np.uint8(BORDER), c[:-1])
        n = np.append(c[1:], np.uint8(BORDER))
        space = (c == SPACE) | (c == WHITE)
        if self.style == "spaced":
            space_before = (p == SPACE) | (p == WHITE)
            # the last white space before a word is a piece of its own, or belongs to the word if it is a space
            cut = np.where(space, ~space_before | (n <= OTHER), np.where(space_before, p == WHITE, c != p))
            if len(lead):
                # a white space of two bytes begins where its first byte does
                wide = lead[c[lead] == WHITE]
                follows = np.append(c, np.uint8(BORDER))[wide + 2]
                before = p[wide]
                cut[wide] = ~((before == SPACE) | (before == WHITE)) | (follows <= OTHER)
                cut[wide + 1] = False
            safe = (c == SPACE) & (n <= OTHER)
            start = (p != SPACE) & (p != OTHER) & (p != STRANGE)
        else:
            cut = (c != p) & ~(space & ((p == SPACE) | (p == WHITE))) | (c == NUMBER) & ((a & 0xC0) != 0x80)
            safe = space & ((a & 0xC0) != 0x80)
            start = (p != OTHER) & (p != STRANGE)
        border = (c == BORDER) | (p == BORDER)
        cut |= border
        mark = np.flatnonzero((a == 39) & start)
        if len(mark):
            after = np.append(a, np.frombuffer(_BORDER * 3, np.uint8)) | np.uint8(32 if self.style == "word" else 0)
            one, two = after[mark + 1], after[mark + 2]
            single = np.isin(one, np.frombuffer(b"stmd", np.uint8))
            double = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
            for at, size in ((mark[single], 2), (mark[double], 3)):
                cut[at + 1] = False
                if size == 3:
                    cut[at + 2] = False
                cut[at + size] = True
        strange = c == STRANGE
        raw = None
        if strange.any():
            safe |= border
            stretch = np.cumsum(safe)
            flag = np.zeros(int(stretch[-1]) + 1, bool)
            flag[stretch[strange]] = True
            raw = flag[stretch]
            cut[raw] = safe[raw]
            # a stretch ends where the next begins
            cut |= safe & np.append(False, raw[:-1])
        if self.style == "word":
            a = a.copy()
            upper = (a >= 65) & (a <= 90)
            low = self.lower[point]
            if raw is not None:
                upper &= ~raw
                keep = ~raw[lead]
                lead, low = lead[keep], low[keep]
            a[upper] += 32
            a[lead], a[lead + 1] = 0xC0 | (low >> 6), 0x80 | (low & 63)
        return a, np.flatnonzero(cut)

    def _round(self, data: list[bytes]) -> list[bytes]:
        import numpy as np
        import pyarrow as pa

        buffer = _BORDER.join([*data, b""])
        a, starts = self._cuts(np.frombuffer(buffer, np.uint8))
        offsets = np.append(starts, len(a)).astype(np.int64)
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(a)]).dictionary_encode()
        get, made = self.memory.get, []
        for piece in pieces.dictionary.to_pylist():
            ids = get(piece)
            if ids is None:
                ids = self._piece(piece)
                if len(piece) <= LONGEST:
                    self.memory.young[piece] = ids
            made.append(ids)
        self.memory.age()
        width = np.dtype(self.dtype).itemsize
        size = np.fromiter(map(len, made), np.int64, len(made)) // width
        known, begin = np.frombuffer(b"".join(made), self.dtype), np.cumsum(size) - size
        number = pieces.indices.to_numpy()
        each = size[number]
        until = np.cumsum(each)
        ids = known[np.repeat(begin[number] - until + each, each) + np.arange(until[-1])]
        ends = until[np.flatnonzero(a[starts] == 0xFF)].tolist()
        return [ids[i:j].tobytes() for i, j in zip([0, *ends], ends)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as raw bytes."""
        import numpy as np

        if self.style is None:
            return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        out: list = [None] * len(texts)
        held, at, size = [], [], 0
        for i, t in enumerate(texts):
            if self.added and any(s in t for s in self.added):
                out[i] = self._library(t)
                continue
            held.append(t.encode())
            at.append(i)
            size += len(held[-1])
            if size >= AT_ONCE:
                for k, ids in zip(at, self._round(held)):
                    out[k] = ids
                held, at, size = [], [], 0
        if held:
            for k, ids in zip(at, self._round(held)):
                out[k] = ids
        return out
