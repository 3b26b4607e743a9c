"""Token ids of many texts with a cache of word pieces.

A tokenizer splits a text into parts and encodes each part alone. Texts are cut where both
tokenizers always split, at a single space between two visible characters; the pieces
repeat, so most ids come from a cache. Pieces that aren't cached are encoded by the library,
many in one text. Where a piece's ids end is told by the vocabulary itself: a byte-level
piece has one token that begins with a space, its first; a word-level tokenizer closes each
word with a token of its own form. Pieces of which neither is sure get a mark between them,
which no piece contains and both tokenizers keep apart, or are encoded alone. A text that
holds one of the tokenizer's special tokens is encoded whole, as the library does it.

A tokenizer of known rules (``WORD_RULES``: lower case, runs of letters, nothing made of white
space) is cut finer: plain texts are lowered, and letters are parted from signs, so far fewer
pieces differ. Its words need none of these rules any more: they are learned by its
vocabulary and byte alphabet alone.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np

#: Pieces in each of the cache's two generations; the older one goes when the newer is full.
CACHE = 250_000
_ENCODERS: dict[str, Encoder] = {}
#: A visible ASCII character or Latin letter; a Latin letter that lower-cases to one letter.
SEEN, LETTER = "\x21-\x7eÀ-ɏ", "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: A space with such a character on either side; a character that may stand beside no cut.
CUT, ODD = re.compile(f"(?<=[{SEEN}]) (?=[{SEEN}])"), re.compile(f"[^\n {SEEN}]")
#: Begins the key of a text's first piece, which has no space before it.
FIRST = "\x00"
#: Keys whose piece is one token group in a byte-level tokenizer; is a word; a word and signs.
WHOLE = re.compile(f"[{SEEN}](?:[^ ]*[{SEEN}])?")
WORD, SIGNED = re.compile(f"[{LETTER}]+"), re.compile(f"[{LETTER}]+[!-/:-@\\[-`{{-~]+")
#: Stands between pieces of one text. Its last character is one id and in no such piece.
MARK = "\n~"
PLAIN = re.compile("[\x21-\x7dÀ-ɏ](?:[^~]*[\x21-\x7dÀ-ɏ])?")
JOINED = 500
#: Rules by which white space only parts, case is lost, and letters never join signs but after "'".
WORD_RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"},
    ]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ]},
}
#: Runs of letters, and of all else but white space; where a text has "'", what it stands in stays whole.
RUNS = re.compile(f"[{LETTER}]+|[^ \n{LETTER}]+")
QUOTED = re.compile(f"(?<![^ \n])[^ \n']*'[^ \n]*|[{LETTER}]+|[^ \n{LETTER}]+")


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        # A task has one core; the library's own threads only add to its time.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.mark = self.tokenizer.encode(" a" + MARK, add_special_tokens=False).ids[1:]
        tokens = self.tokenizer.get_vocab(with_added_tokens=True)
        self.opens, self.closes = (np.zeros(max(tokens.values()) + 1, bool) for _ in range(2))
        for token, number in tokens.items():
            self.opens[number], self.closes[number] = token.startswith("Ġ"), token.endswith("</w>")
        self.by_words = bool(self.closes.any())
        rules = json.loads(self.tokenizer.to_str())
        self.parted = self.by_words and all(rules[k] == v for k, v in WORD_RULES.items())
        self.bare = self.tokenizer
        if self.parted:
            self.bare = Tokenizer.from_file(path)
            self.bare.normalizer = normalizers.Sequence([])
            self.bare.pre_tokenizer = pre_tokenizers.Sequence([
                pre_tokenizers.Split(" ", "removed"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ])

    @classmethod
    def of(cls, path: str) -> Encoder:
        """The worker's encoder of this file: its cache serves later tasks too."""
        if path not in _ENCODERS:
            _ENCODERS[path] = cls(path)
        return _ENCODERS[path]

    def encode(self, texts: list[str | None], end: int) -> list[np.ndarray]:
        """Ids of each text (null: none), then ``end``."""
        cut = [self.pieces(t) for t in texts]
        if len(self.young) > CACHE:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        flat = list(chain.from_iterable(c for c in cut if c is not None))
        found = list(map(young.get, flat))
        holes = [i for i, ids in enumerate(found) if ids is None]
        fresh = []
        for piece in {flat[i] for i in holes}:
            if piece in old:
                young[piece] = old[piece]
            else:
                fresh.append(piece)
        self.learn(fresh)
        for i in holes:
            found[i] = young[flat[i]]
        last, at, out = np.array([end], "<u4").tobytes(), 0, []
        for text, pieces in zip(texts, cut):
            if pieces is None:
                raw = self.alone(text)
            else:
                raw = b"".join(found[at : at + len(pieces)])
                at += len(pieces)
            out.append(np.frombuffer(raw + last, "<u4"))
        return out

    def alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, fresh: list[str]) -> None:
        """Puts the ids of pieces into the cache."""
        if self.by_words:
            sure = [p for p in fresh if WORD.fullmatch(p) and (not self.parted or p.islower())]
            signed = [p for p in fresh if SIGNED.fullmatch(p)]
            rest = list(set(fresh).difference(sure, signed))
            rest += self.together(sure, self.closes, 1, self.bare) + self.together(signed, self.closes, 2)
        else:
            sure = [p for p in fresh if WHOLE.fullmatch(p)]
            rest = list(set(fresh).difference(sure))
            rest += self.together(sure, self.opens, 1)
        plain = [p for p in rest if PLAIN.fullmatch(p)]
        self.marked(plain)
        for piece in set(rest).difference(plain):
            self.young[piece] = self.alone(piece[1:] if piece.startswith(FIRST) else " " + piece)

    def together(self, pieces: list[str], flags: np.ndarray, count: int, tokenizer=None) -> list[str]:
        """Encodes pieces side by side, each of which has ``count`` flagged tokens: its first
        (a space opens it) or its last ones (they close its words). Returns those that differ."""
        young, left = self.young, []
        for group, ids in self.batches(pieces, lambda some: " " + " ".join(some), tokenizer):
            at = np.flatnonzero(flags[ids])
            if len(at) != count * len(group):
                left += group
                continue
            cuts = 4 * (np.append(at, len(ids)) if not self.by_words else np.append(0, at[count - 1 :: count] + 1))
            raw = ids.tobytes()
            cuts = cuts.tolist()
            young.update(zip(group, [raw[a:b] for a, b in zip(cuts, cuts[1:])]))
        return left

    def marked(self, pieces: list[str]) -> None:
        """Encodes pieces with a mark after each."""
        young, skip = self.young, 4 * len(self.mark)
        for group, ids in self.batches(pieces, lambda some: MARK.join([*(" " + p for p in some), ""])):
            cuts = (4 * (np.flatnonzero(ids == self.mark[-1]) + 1)).tolist()
            raw, start = ids.tobytes(), 0
            for piece, stop in zip(group, cuts, strict=True):
                young[piece] = raw[start : stop - skip]
                start = stop

    def batches(self, pieces: list[str], write, tokenizer=None):
        """Groups of pieces and the ids of the text that ``write`` makes of each."""
        groups = [pieces[at : at + JOINED] for at in range(0, len(pieces), JOINED)]
        for at in range(0, len(groups), 40):
            some = groups[at : at + 40]
            for group, got in zip(some, (tokenizer or self.tokenizer).encode_batch_fast([write(g) for g in some], add_special_tokens=False)):
                yield group, np.array(got.ids, "<u4")

    def pieces(self, text: str | None) -> list[str] | None:
        """Keys of the pieces of a text: the piece without the space before it. None for a text
        with a special token."""
        if not text:
            return []
        for special in self.special:
            if special in text:
                return None
        if self.parted:
            low = text.lower()
            if not ODD.search(low) and not any(special in low for special in self.special):
                return (QUOTED if "'" in low else RUNS).findall(low)
        if ODD.search(text) or "  " in text or " \n" in text or "\n " in text or text[0] == " " or text[-1] == " ":
            parts = CUT.split(text)
        else:
            parts = text.split(" ")
        parts[0] = FIRST + parts[0]
        return parts
