"""Token counts under a unigram model, worked out once for each shared prefix.

A text's pre-tokens are its words behind a word mark. Their best segmentation
into pieces is a forward pass over the characters: the score of a prefix is the
best over its last piece of the score before it plus the piece's log
probability. Distinct pre-tokens are inserted in a trie that a task keeps across
its batches: a prefix that several share is one node and is scored once, and the
node where a pre-token ends has its count of tokens.

Pieces and their order come from a public vocabulary file; its order of merges
stands for frequency, so the piece of rank r (from 0) has probability
proportional to 1 / (r + 2) (Zipf). A character that no piece holds costs a
byte token for each of its UTF-8 bytes, less likely than any piece.
"""

from __future__ import annotations

import math

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coursewise.llm.common import texts

MARK = "▁"


class Unigram:
    """Log probabilities of the normal pieces of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        normal = [i for i in range(model.get_piece_size())
                  if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        total = math.log(sum(1 / (r + 2) for r in range(len(normal))))
        self.logp = {model.id_to_piece(i): -math.log(r + 2) - total for r, i in enumerate(normal)}
        self.byte = min(self.logp.values(), default=0.0) - 10
        self.longest = max(map(len, self.logp), default=1)


class Trie:
    """A trie of pre-tokens whose nodes keep the forward scores of their prefixes.

    A node is known by its parent and its character. Inserting a pre-token
    walks the nodes it shares with those inserted before, and scores only the
    prefixes that are new; the node where it ends has its count of tokens and
    its score.
    """

    def __init__(self, model: Unigram):
        self.model = model
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]

    def __len__(self) -> int:
        return len(self.best)

    def insert(self, word: str) -> int:
        """The node where ``word`` ends. Of equally good last pieces the longest is taken."""
        child, all_best, all_count = self.child, self.best, self.count
        path = [0]
        for c in word:
            node = child.get(path[-1] << 21 | ord(c))
            if node is None:
                break
            path.append(node)
        logp, longest, byte = self.model.logp.get, self.model.longest, self.model.byte
        best, count = [all_best[n] for n in path], [all_count[n] for n in path]
        for d in range(len(path), len(word) + 1):
            top, n = -math.inf, 0
            for a in range(max(0, d - longest), d):
                p = logp(word[a:d])
                if p is not None and best[a] + p > top:
                    top, n = best[a] + p, count[a] + 1
            if n == 0:
                width = len(word[d - 1].encode("utf-8", "surrogatepass"))
                top, n = best[d - 1] + width * byte, count[d - 1] + width
            best.append(top)
            count.append(n)
            child[path[-1] << 21 | ord(word[d - 1])] = len(all_best)
            path.append(len(all_best))
            all_best.append(top)
            all_count.append(n)
        return path[-1]


def token_counts(docs: DataFrame, path: str | None = None, max_nodes: int = 600_000,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_pretokens, n_tokens, score) of every row.

    ``score`` is the log probability of the best segmentation of all
    pre-tokens. A null or empty text has none: 0, 0, 0.0. Repeated rows get
    equal results, null ids stay null, other columns aren't looked at.
    A task has one trie. Beyond ``max_nodes`` nodes it begins a new one, and as
    many pre-tokens stay known by their counts; neither changes any result.
    """
    path = path or public_tokenizers.path("piece_bpe_32k.model")

    def run(batches):
        model = Unigram(path)
        trie, tokens, scores = Trie(model), {}, {}
        for b in batches:
            for at in range(0, b.num_rows, 500):
                rows = b.slice(at, 500)
                split = [(t or b"").split() for t in texts(rows.column(1))]
                if len(tokens) > max_nodes:
                    tokens, scores = {}, {}
                for w in {w for words in split for w in words if w not in tokens}:
                    if len(trie) > max_nodes:
                        trie = Trie(model)
                    end = trie.insert(MARK + w.decode())
                    tokens[w], scores[w] = trie.count[end], trie.best[end]  # the terminals by their bytes
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array([len(w) for w in split], pa.int64()),
                     pa.array([sum(map(tokens.__getitem__, w)) for w in split], pa.int64()),
                     pa.array([math.fsum(map(scores.__getitem__, w)) for w in split], pa.float64())],
                    ["doc_id", "n_pretokens", "n_tokens", "score"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long, score double")


def op10_trie_token_counts(spark, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return token_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
