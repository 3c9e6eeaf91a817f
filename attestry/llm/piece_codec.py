"""SentencePiece BPE encoding by a table of last tokens, and decoding.

The BPE encoding of a text begins with the encodings of its prefixes: for every prefix there is one token that ends it. The table of these
last tokens is filled from left to right. An automaton over the vocabulary lists the tokens that end at a position; the right one is the
token that may follow the last token of the prefix before it. Two tokens may follow each other if merging their joined characters gives
exactly these two again (kept in a memo). Walking back from the end of the table recovers the ids. The work is linear in the text's
length. Stretches of a batch are filled together, one array operation per position; long ones are filled one by one.

No token but a run of ``▁`` holds ``▁`` after its start, and none holds a line end, so texts are cut there first and equal stretches
are looked up in a bounded memo. Characters outside the vocabulary become byte tokens. Defined results: a null text counts as empty and has
no ids; null ids and repeated rows are carried; texts of any length are encoded whole; of tokens that could end a prefix one alone follows the one before
it, so there are no ties; an empty table gives an empty one; other columns, whatever their names, play no part. No shuffle.
"""

from __future__ import annotations

import hashlib
import re
from functools import lru_cache
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame

from attestry.llm.tables import Recent, per_batch

SPACE = "▁"
#: Longest stretch that is filled together with others, and stretches kept in the memo.
TOGETHER = 64
MEMO = 200_000
STRETCH = re.compile(f"\n|{SPACE}+[^{SPACE}\n]*|[^{SPACE}\n]+")


class PieceCodec:
    """Encoder and decoder of one model file."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.library = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.scores: dict[str, float] = {}
        self.ids: dict[str, int] = {}
        self.byte_ids: dict[int, int] = {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece], self.scores[piece] = i, sp.get_score(i)
        assert not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids), "stretches cannot be cut at spaces and line ends"
        # Tokens that merging cannot reach never appear.
        self.pieces = {i: p for p, i in self.ids.items() if self.merged(p) == [p]}
        self._grow()
        self.follow = Recent(self._follows, 300_000)
        self.lengths = np.array([len(self.pieces.get(i, "")) for i in range(sp.get_piece_size())], np.int64)
        # A direct-mapped copy of `follow` for whole arrays of pairs: the pair in a slot, and its answer.
        self.slot_pair = np.full(1 << 20, -1, np.int64)
        self.slot_follows = np.zeros(1 << 20, bool)
        self.stretches: dict[str, list[int]] = {}
        self.written = [str(i) for i in range(sp.get_piece_size())]

    def _grow(self) -> None:
        """The automaton of the vocabulary: edges (state, character) -> state in an open hash table, and the token of each state."""
        edges: dict[int, int] = {}
        token = [-1]
        for i, piece in self.pieces.items():
            state = 0
            for ch in piece:
                key = state << 21 | ord(ch)
                if key not in edges:
                    edges[key] = len(token)
                    token.append(-1)
                state = edges[key]
            token[state] = i
        self.state_token = np.array(token, np.int64)
        self.edge_key = np.full(1 << 19, -1, np.int64)
        self.edge_to = np.zeros(1 << 19, np.int64)
        for key, state in edges.items():
            slot = (key * 0x9E3779B1 >> 13) & 0x7FFFF
            while self.edge_key[slot] >= 0:
                slot = (slot + 1) & 0x7FFFF
            self.edge_key[slot], self.edge_to[slot] = key, state

    def _next(self, states: np.ndarray, characters: np.ndarray) -> np.ndarray:
        """The states after one character each; -1 where there is no edge."""
        keys = states << 21 | characters
        slots = (keys * 0x9E3779B1 >> 13) & 0x7FFFF
        held = self.edge_key[slots]
        out = np.where(held == keys, self.edge_to[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & 0x7FFFF
            held = self.edge_key[slots[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.edge_to[slots[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out

    def matches(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and ids of all tokens inside ``text``: the automaton runs from every character at once."""
        characters = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        at, states, depth, found = np.arange(len(characters)), np.zeros(len(characters), np.int64), 0, []
        while len(at):
            states = self._next(states, characters[at + depth])
            depth += 1
            alive = states > 0
            at, states = at[alive], states[alive]
            token = self.state_token[states]
            known = token >= 0
            found.append((at[known], at[known] + depth, token[known]))
            inside = at + depth < len(characters)
            at, states = at[inside], states[inside]
        if not found:
            return (np.zeros(0, np.int64),) * 3
        return tuple(np.concatenate(c) for c in zip(*found))

    def merged(self, text: str, border: int = -1) -> list[str] | None:
        """Merges of best score, leftmost first, from single characters; None as soon as one would cross ``border``."""
        parts, ends = list(text), list(range(1, len(text) + 1))
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            if ends[at] == border:
                return None
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ends[at]
        return parts

    def _follows(self, pair: int) -> bool:
        first, second = self.pieces[pair >> 20], self.pieces[pair & 0xFFFFF]
        return self.merged(first + second, len(first)) == [first, second]

    def table(self, text: str) -> list[int]:
        """The id of the token that ends each prefix, by its length; -1 after a character outside the vocabulary, and for the empty prefix."""
        last = [-1] * (len(text) + 1)
        starts, ends, tokens = self.matches(text)
        order = np.argsort(ends, kind="stable")
        for start, end, token in zip(starts[order].tolist(), ends[order].tolist(), tokens[order].tolist()):
            if last[end] < 0 and (last[start] < 0 or self.follow[last[start] << 20 | token]):
                last[end] = token
        return last

    def follows(self, pairs: np.ndarray) -> np.ndarray:
        slots = (pairs * 0x9E3779B1 >> 11) & (len(self.slot_pair) - 1)
        unknown = self.slot_pair[slots] != pairs
        out = self.slot_follows[slots]
        if unknown.any():
            some, at = np.unique(pairs[unknown], return_inverse=True)
            answers = np.fromiter(map(self.follow.__getitem__, some.tolist()), bool, len(some))
            out[unknown] = answers[at]
            slots = (some * 0x9E3779B1 >> 11) & (len(self.slot_pair) - 1)
            self.slot_pair[slots] = some
            # Of pairs that share a slot, one remains: the answers are written for the pair that did.
            stays = self.slot_pair[slots] == some
            self.slot_follows[slots[stays]] = answers[stays]
        return out

    def one(self, text: str) -> list[int]:
        """Ids of one stretch."""
        last, ids, end = self.table(text), [], len(text)
        while end:
            token = last[end]
            if token >= 0:
                ids.append(token)
                end -= len(self.pieces[token])
            else:
                end -= 1
                ids += [self.byte_ids[b] for b in reversed(text[end].encode("utf-8", "surrogatepass"))]
        ids.reverse()
        return ids

    def many(self, texts: list[str]) -> list[list[int]]:
        """Ids of stretches of at most ``TOGETHER`` characters, without line ends."""
        joined = "\n".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        starts, ends, tokens = self.matches(joined)
        local = (np.arange(len(joined) + 1) - np.repeat(begins, np.append(sizes[:-1] + 1, sizes[-1] + 1)))[ends].astype(np.uint8)
        order = np.argsort(local, kind="stable")
        starts, ends, tokens = starts[order], ends[order], tokens[order]
        # last[i]: the token that ends before character i; the places between stretches hold none.
        last = np.full(len(joined) + 1, -1, np.int64)
        border = np.concatenate(([0], np.cumsum(np.bincount(local, minlength=1))))
        for low, high in zip(border[:-1].tolist(), border[1:].tolist()):
            previous = last[starts[low:high]]
            right = previous < 0
            inner = np.flatnonzero(~right)
            right[inner] = self.follows(previous[inner] << 20 | tokens[low:high][inner])
            last[ends[low:high][right]] = tokens[low:high][right]
        rows, at, steps = np.arange(len(texts)), begins + sizes, []
        while len(rows):
            token = last[at]
            steps.append((rows, np.where(token < 0, -1 - at, token)))
            at = at - np.where(token < 0, 1, self.lengths[token])
            going = at > begins[rows]
            rows, at = rows[going], at[going]
        row = np.concatenate([r for r, _ in reversed(steps)])
        token = np.concatenate([t for _, t in reversed(steps)])
        order = np.argsort(row.astype(np.uint16), kind="stable")
        flat, cuts = token[order].tolist(), np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(texts))))).tolist()
        out = [flat[a:b] for a, b in zip(cuts[:-1], cuts[1:])]
        for r in np.unique(row[token < 0]).tolist():
            out[r] = list(chain.from_iterable((t,) if t >= 0 else (self.byte_ids[b] for b in joined[-t - 2].encode("utf-8", "surrogatepass")) for t in out[r]))
        return out

    def cut(self, text: str) -> list[str]:
        """The stretches of ``text``."""
        if not text:
            return []
        marked = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 in marked:
            return STRETCH.findall(marked)
        return [s for s in marked.replace("\n", " \n ").replace(SPACE, " " + SPACE).split(" ") if s]

    def _learn(self, cuts: list[list[str]]) -> None:
        """Put every stretch of ``cuts`` into the memo, which is emptied first when it is full."""
        for again in (False, True):
            if again or len(self.stretches) > MEMO:
                self.stretches.clear()
            new = {s for stretches in cuts for s in stretches if s not in self.stretches}
            if len(self.stretches) + len(new) <= 2 * MEMO or not self.stretches:
                break
        short = [s for s in new if len(s) <= TOGETHER and s != "\n"]
        for at in range(0, len(short), 20_000):
            part = short[at : at + 20_000]
            self.stretches.update(zip(part, self.many(part)))
        for s in new:
            if s not in self.stretches:
                self.stretches[s] = self.one(s)

    def encode_batch(self, texts: list[str | None]) -> list[tuple[list[int], str]]:
        """For each text its ids, and the ids in decimal joined by commas."""
        cuts = [self.cut(t or "") for t in texts]
        self._learn(cuts)
        out = []
        for stretches in cuts:
            ids = list(chain.from_iterable(map(self.stretches.__getitem__, stretches)))
            out.append((ids, ",".join(map(self.written.__getitem__, ids))))
        return out

    def encode(self, text: str | None) -> list[int]:
        return self.encode_batch([text])[0][0]

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids) if ids else ""


@lru_cache(maxsize=2)
def codec(model_file: str) -> PieceCodec:
    """One codec per worker and file."""
    return PieceCodec(model_file)


def encoded(docs: DataFrame, model_file: str, key: str = "doc_id") -> DataFrame:
    """One row per row of ``docs``: its key and ``ids``."""
    kind = dict(docs.dtypes)[key]
    return per_batch(docs.select(key, "text"), lambda c: [c[0], [ids for ids, _ in codec(model_file).encode_batch(c[1])]], f"`{key}` {kind}, ids array<int>")


def decoded(rows: DataFrame, model_file: str, key: str = "doc_id") -> DataFrame:
    """One row per row of ``rows`` (key, ids): its key and ``text``; null ids give null."""
    kind = dict(rows.dtypes)[key]
    return per_batch(
        rows.select(key, "ids"), lambda c: [c[0], [None if i is None else codec(model_file).decode(i) for i in c[1]]], f"`{key}` {kind}, text string"
    )


def digests(docs: DataFrame, model_file: str, key: str = "doc_id") -> DataFrame:
    """Encoding and decoding of every text as digests, in one pass."""
    kind = dict(docs.dtypes)[key]

    def rows(columns: list) -> list:
        own = codec(model_file)
        counts, ids_sha, text_sha = [], [], []
        for ids, written in own.encode_batch(columns[1]):
            counts.append(len(ids))
            ids_sha.append(hashlib.sha256(written.encode()).hexdigest())
            text_sha.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return [columns[0], counts, ids_sha, text_sha]

    return per_batch(docs.select(key, "text"), rows, f"`{key}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
