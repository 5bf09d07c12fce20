"""Token counts under a unigram model, with the work of shared prefixes done once.

The distinct pre-tokens of a lot (words with a word-start mark) form a trie, kept as one array of nodes per
depth. Forward scores, the best log-probability of any segmentation of the prefix that ends at a node, are
computed depth by depth for all nodes at once: each node carries the open pieces (a position where a piece
began, and how far it has come in the vocabulary's trie), each child moves them on by its character. A
word's token count is stored at the node where it ends. Among segmentations of the same score the one with
the fewest tokens counts. Where few words are left, which a depth at a time would take long over, the trie is
walked word by word from there, in order, each word from the node at which it leaves the one before.

Piece scores are a unigram file's own log-probabilities. A file of merge ranks has none; there the
probability of a piece is taken as proportional to 1 / (rank + 1). A character that no piece covers costs
one token for each of its UTF-8 bytes.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import short_batches, stateless
from .wordbpe import Numbers, portions

MARK = "▁"
WORDS = re.compile("[^\x20\x09-\x0d]+")
#: str.split() parts words here too, the contracts don't.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
#: Words up to which the trie is walked word by word.
TAIL = 32
CACHED = 200_000
LOT = 40_000
BYTE_PENALTY = 10.0
BYTE_PIECE = re.compile("<0x[0-9A-F]{2}>")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def load_pieces(path: str) -> dict[str, float]:
    """Piece -> log-probability, without control, unknown and byte pieces."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces = {model.id_to_piece(i): model.get_score(i) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))}
    scores = np.array(list(pieces.values()))
    if len(scores) and (scores == np.round(scores)).all():  # merge ranks
        rank = scores.max() - scores
        scores = -np.log(rank + 1) - np.log((1 / (rank + 1)).sum())
    return dict(zip(pieces, scores.tolist(), strict=True))


class Unigram:
    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces), default=0)
        self.byte_score = min(pieces.values(), default=0.0) - BYTE_PENALTY
        nodes = {"": 0}
        for p in pieces:
            for i in range(1, len(p) + 1):
                nodes.setdefault(p[:i], len(nodes))
        inner = [(nodes[p[:-1]] << 21 | ord(p[-1]), n) for p, n in nodes.items() if p]
        inner.sort()
        self.key = np.array([k for k, _ in inner], np.int64)
        self.target = np.array([t for _, t in inner], np.int64)
        self.arcs: dict[int, int] = {}
        self.values: list[float] = []
        self.value = np.full(len(nodes), -np.inf)
        for p, s in pieces.items():
            self.value[nodes[p]] = s

    def _step(self, state: np.ndarray, char: np.ndarray) -> np.ndarray:
        if not len(self.key):
            return np.full(len(state), -1)
        want = state << 21 | char
        at = np.minimum(np.searchsorted(self.key, want), len(self.key) - 1)
        return np.where(self.key[at] == want, self.target[at], -1)

    def _walk(self, words: list[str], depth: int, node: list[tuple]) -> Iterator[tuple[int, float]]:
        """(count, score) of each of the words, which are in order and go on from depth; node: what is known at each one's prefix.

        A node is (score, count, open pieces); an open piece is (vocabulary state, score, count where it began).
        """
        if not self.arcs:
            self.arcs, self.values = dict(zip(self.key.tolist(), self.target.tolist(), strict=True)), self.value.tolist()
        arcs, value, byte_score = self.arcs, self.values, self.byte_score
        shared = [0] + [len(os.path.commonprefix([a, b])) for a, b in zip(words, words[1:], strict=False)]
        marks: dict[int, tuple] = {}
        for i, word in enumerate(words):
            start = max((d for d in marks if d <= shared[i]), default=None)
            marks = {d: n for d, n in marks.items() if d <= shared[i]}
            later = set(shared[i + 1 :])
            at, (score, count, pieces) = (depth, node[i]) if start is None else (start, marks[start])
            for d in range(at, len(word)):
                if d in later:
                    marks[d] = score, count, pieces
                c = ord(word[d])
                width = 1 + (c >= 0x80) + (c >= 0x800) + (c >= 0x10000)
                top, least, still = score + width * byte_score, count + width, []
                for state, s, n in [*pieces, (0, score, count)]:
                    to = arcs.get(state << 21 | c, -1)
                    if to >= 0:
                        still.append((to, s, n))
                        whole = s + value[to]
                        if whole > top or (whole == top and n + 1 < least):
                            top, least = whole, n + 1
                score, count, pieces = top, least, still
            if len(word) in later:
                marks[len(word)] = score, count, pieces
            yield count, score

    def many(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(counts, scores) of words, each sharing its prefixes with the others."""
        counts, scores = np.zeros(len(words), np.int64), np.zeros(len(words))
        number = np.array(sorted((i for i, w in enumerate(words) if w), key=words.__getitem__), np.int64)
        if not len(number):
            return counts, scores
        lengths = np.array([len(words[i]) for i in number])
        chars = np.frombuffer("".join(words[i] for i in number).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        begin = np.cumsum(lengths) - lengths
        forward, tokens = np.zeros(1), np.zeros(1, np.int64)  # of the nodes of a depth, here the root
        node_of = np.zeros(len(number), np.int64)  # of each word that goes on
        live = np.arange(len(number))
        # open pieces, in order of their node: node, vocabulary state, score and count where they began
        at, state, from_score, from_count = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))
        depth = 0
        while len(live) > TAIL:
            char = chars[begin[live] + depth]
            new = np.r_[True, (node_of[1:] != node_of[:-1]) | (char[1:] != char[:-1])]
            parent, label = node_of[new], char[new]
            child_of = np.cumsum(new) - 1
            # the pieces that begin at each node join those that are open there
            every = np.arange(len(forward))
            at, state = np.concatenate([at, every]), np.concatenate([state, np.zeros(len(every), np.int64)])
            from_score, from_count = np.concatenate([from_score, forward]), np.concatenate([from_count, tokens])
            order = np.argsort(at, kind="stable")
            first = np.searchsorted(at[order], every)
            size = np.diff(np.r_[first, len(at)])
            each = size[parent]
            source = order[np.repeat(first[parent] - np.cumsum(each) + each, each) + np.arange(each.sum())]
            to = np.repeat(np.arange(len(parent)), each)
            moved = self._step(state[source], label[to])
            ok = moved >= 0
            at, state, source = to[ok], moved[ok], source[ok]
            from_score, from_count = from_score[source], from_count[source]
            width = 1 + (label >= 0x80) + (label >= 0x800) + (label >= 0x10000)
            best, least = forward[parent] + width * self.byte_score, tokens[parent] + width
            ends = self.value[state] > -np.inf
            node, score, count = at[ends], from_score[ends] + self.value[state[ends]], from_count[ends] + 1
            rank = np.lexsort((count, -score, node))
            lead = rank[np.r_[True, node[rank][1:] != node[rank][:-1]]] if len(rank) else rank
            better = (score[lead] > best[node[lead]]) | ((score[lead] == best[node[lead]]) & (count[lead] < least[node[lead]]))
            lead = lead[better]
            best[node[lead]], least[node[lead]] = score[lead], count[lead]
            forward, tokens, depth = best, least, depth + 1
            ended = lengths[live] == depth
            over = number[live[ended]]
            counts[over], scores[over] = tokens[child_of[ended]], forward[child_of[ended]]
            live, node_of = live[~ended], child_of[~ended]
        if len(live):
            nodes = {k: (float(forward[k]), int(tokens[k]), [(int(state[j]), float(from_score[j]), int(from_count[j])) for j in np.flatnonzero(at == k)]) for k in set(node_of.tolist())}
            for i, (c, s) in zip(number[live], self._walk([words[i] for i in number[live]], depth, [nodes[k] for k in node_of.tolist()]), strict=True):
                counts[i], scores[i] = c, s
        return counts, scores


def count(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row per row of df: id, n_words, n_tokens, log_prob (sum over its words).

    Null text counts as empty: no words, no tokens, 0. Repeated rows give repeated results; an empty table gives an
    empty result. Only the two columns are read.
    """
    path = path or default_path()
    own = short_batches(df).select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stateless()
        model = Unigram(load_pieces(path))
        known, counts, scores = Numbers(), np.zeros(0, np.int64), np.zeros(0)
        for batch in batches:
            for a, b, texts in portions(batch.column(1)):
                if len(known) > CACHED:
                    known, counts, scores = Numbers(), np.zeros(0, np.int64), np.zeros(0)
                before = len(known)
                number = known.__getitem__
                of = [np.array(list(map(number, WORDS.findall(t) if OTHER_SPACE.search(t) else t.split())), np.int64) for t in texts]
                fresh = list(known)[before:]
                for i in range(0, len(fresh), LOT):
                    c, s = model.many([MARK + w for w in fresh[i : i + LOT]])
                    counts, scores = np.concatenate([counts, c]), np.concatenate([scores, s])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array([len(x) for x in of], pa.int64()), pa.array([int(counts[x].sum()) for x in of], pa.int64()), pa.array([float(scores[x].sum()) for x in of], pa.float64())],
                    names=["doc_id", "n_words", "n_tokens", "log_prob"],
                )

    out = own.mapInArrow(run, "doc_id long, n_words long, n_tokens long, log_prob double")
    return out if id_col == "doc_id" else out.withColumnRenamed("doc_id", id_col)
