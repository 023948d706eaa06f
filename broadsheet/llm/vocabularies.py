"""Token ids from vocabulary files, exactly as the files' own libraries give them.

The libraries' merge loops are slow on running text. Both vocabularies never merge across the
edge in front of a space, so texts are cut there and the pieces merged by one fast routine.
The tests hold the ids against the libraries. A file's content is handed over, not its path:
workers need not see the driver's disk.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import tiktoken

# Fixed value: how the byte-level vocabulary's tokenizer cuts a text before merging, without
# its look-ahead for runs of white space, which ``ByteLevel`` cuts itself.
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
# Runs of Unicode's white space.
_RUNS = re.compile("[\t-\r \x85\xa0  -     　]{2,}")
# A space as sentence pieces write it.
SPACE = "\u2581"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def content_of(path: str) -> bytes:
    """The vocabulary file, read where the driver is; a few megabytes at any size of corpus."""
    with open(path, "rb") as file:
        return file.read()


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _lengths(tokens: dict[int, bytes]) -> np.ndarray:
    sizes = np.zeros(max(tokens) + 1, np.int64)
    for i, token in tokens.items():
        sizes[i] = len(token)
    return sizes


class ByteLevel:
    """A byte-level BPE vocabulary in the JSON form of ``tokenizers``.

    Strings of special tokens inside a text are special tokens, or with ``plain`` ordinary text.
    """

    def __init__(self, content: bytes, plain: bool = False):
        file = json.loads(content)
        letters = _byte_letters()
        special = {t["content"]: t["id"] for t in file.get("added_tokens", [])}
        ranks = {
            bytes(letters[c] for c in token): i for token, i in file["model"]["vocab"].items() if token not in special
        }
        self._encode = tiktoken.Encoding("bytes", pat_str=_PIECES, mergeable_ranks=ranks, special_tokens={})
        self._special = {} if plain else {s: np.array([i], "<u4") for s, i in special.items()}
        self._split = re.compile("(%s)" % "|".join(map(re.escape, sorted(special, key=len, reverse=True)))).split
        self.lengths = _lengths({i: token for token, i in ranks.items()} | {i: s.encode() for s, i in special.items()})

    def _ordinary(self, text: str) -> list[np.ndarray]:
        """A run of white space leaves its last character to the word that follows."""
        parts, at = [], 0
        for run in _RUNS.finditer(text):
            if run.end() < len(text):
                parts += text[at : run.start()], text[run.start() : run.end() - 1]
                at = run.end() - 1
        parts.append(text[at:])
        return [self._encode.encode_to_numpy(p, disallowed_special=()) for p in parts if p]

    def __call__(self, text: str) -> np.ndarray:
        found: list[np.ndarray] = []
        if self._special and any(s in text for s in self._special):
            for part in self._split(text):
                found += [self._special[part]] if part in self._special else self._ordinary(part)
        else:
            found = self._ordinary(text)
        return found[0] if len(found) == 1 else np.concatenate([np.zeros(0, "<u4"), *found])


class Pieces:
    """A BPE vocabulary of ``sentencepiece`` with byte fallback, which adds a space in front.

    Pieces become byte strings, ranked by score. Characters of several bytes are put together
    before all other merges, by ranks of their own; what remains of characters that are no
    pieces falls back to bytes.
    """

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        ids = range(model.get_piece_size())
        text = {i: model.id_to_piece(i) for i in ids}
        fallback = {int(text[i][3:5], 16): i for i in ids if model.is_byte(i)}
        usual = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        tokens = {i: text[i].replace(SPACE, " ").encode() for i in usual}
        if len(fallback) != 256 or any(re.search(b"[^ ] ", t) for t in tokens.values()):
            raise ValueError("needs byte fallback and no piece that goes on after a space")
        ids_of = {t: i for i, t in tokens.items()}
        ranks: dict[bytes, int] = {}
        meaning: list[list[int]] = []

        def rank(token: bytes, stands_for: list[int]) -> None:
            if token not in ranks:
                ranks[token] = len(meaning)
                meaning.append(stands_for)

        for b in range(256):
            rank(bytes([b]), [ids_of.get(bytes([b]), fallback[b])])
        characters = [t for i, t in tokens.items() if len(text[i]) == 1 and len(t) > 1]
        for size in (2, 3, 4):
            for c in characters:
                if len(c) == size:
                    rank(c, [ids_of[c]])
                elif len(c) > size:
                    rank(c[:size], [fallback[b] for b in c[:size]])
        for i in sorted(usual, key=lambda i: -model.get_score(i)):
            rank(tokens[i], [i])
        self._encode = tiktoken.Encoding("pieces", pat_str=" +[^ ]*", mergeable_ranks=ranks, special_tokens={})
        self._meaning = meaning
        self._several = np.array([len(m) > 1 for m in meaning])
        self._first = np.array([m[0] for m in meaning], "<u4")
        self.lengths = _lengths(tokens | {i: bytes([b]) for b, i in fallback.items()})

    def __call__(self, text: str) -> np.ndarray:
        found = self._encode.encode_to_numpy(" " + text.replace(SPACE, " "), disallowed_special=())
        if self._several[found].any():
            return np.array([i for rank in found.tolist() for i in self._meaning[rank]], "<u4")
        return self._first[found]


@lru_cache(4)
def byte_level(content: bytes, plain: bool = False) -> ByteLevel:
    """Loaded once in a worker."""
    return ByteLevel(content, plain)


@lru_cache(4)
def pieces(content: bytes) -> Pieces:
    """Loaded once in a worker."""
    return Pieces(content)
