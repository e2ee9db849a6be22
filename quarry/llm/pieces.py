"""Reading a merge-type (BPE) SentencePiece model: pieces, scores, pre-tokens.

Pre-tokens.  The library works on the text with spaces written as U+2581 and
one more in front.  If no piece holds a U+2581 after another character, no
merge can cross the place before a run of U+2581, so the text may be cut there
and the parts encoded by themselves; ``PieceModel`` proves that property for
the whole vocabulary when it is loaded, and refuses a model without it.
"""

from __future__ import annotations

import functools
import re

import sentencepiece

SPACE = "▁"
# with spaces written as U+2581: every run of them with what follows
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*")
_CROSSING = re.compile(f"[^{SPACE}]{SPACE}")


class PieceModel:
    """The vocabulary of a .model file as Python tables."""

    def __init__(self, path: str):
        self.lib = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.lib.get_piece_size()
        self.pieces = [self.lib.id_to_piece(i) for i in range(n)]
        special = [self.lib.is_control(i) or self.lib.is_unknown(i) or self.lib.is_byte(i) for i in range(n)]
        self.byte_ids = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.lib.is_byte(i)}
        self.id_bytes = {i: b for b, i in self.byte_ids.items()}
        self.ids = {p: i for i, p in enumerate(self.pieces) if not special[i]}
        self.scores = {p: self.lib.get_score(i) for p, i in self.ids.items()}
        if len(self.byte_ids) != 256:
            raise ValueError("a model with byte fallback is needed")
        if any(_CROSSING.search(p) for p in self.ids):
            raise ValueError("a piece of this model spans words")
        probe = " \t a ﬁ ① "
        if self.lib.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("a model without text normalisation is needed")

    @staticmethod
    def words(text: str) -> list[str]:
        """The pre-tokens of a whole text, each with its leading U+2581."""
        if not text:
            return []
        text = SPACE + text.replace(" ", SPACE)
        if SPACE + SPACE not in text:
            return [SPACE + w for w in text[1:].split(SPACE)]
        return _WORDS.findall(text)

    def library_ids(self, words: list[str]) -> list[list[int]]:
        """The library's ids of pre-tokens; it adds the first U+2581 itself.

        A lone U+2581 is what an empty text would be, for which the library
        adds none, so that one is looked up."""
        out = self.lib.encode([w[1:] for w in words], num_threads=1)
        return [ids if len(w) > 1 else [self.ids[SPACE]] for w, ids in zip(words, out, strict=True)]


@functools.lru_cache(maxsize=4)
def piece_model(path: str) -> PieceModel:
    """Loaded once per Python worker."""
    return PieceModel(path)
