"""Token counts under a unigram model, with forward scores shared in a trie of pre-tokens.

The vocabulary file gives pieces in order of rank; the model takes them as Zipf-distributed, so the log probability of the
piece of rank r is -ln(r + 1) - ln(1 + 1/2 + ... + 1/n). A character in no piece is spelled in UTF-8 bytes, a token each,
at the lowest piece score less ``BYTE_PENALTY``. The best segmentation has the highest sum; of equal sums, the fewest tokens.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterator, Sequence

import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import held, map_batches, rows_in

MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_PENALTY = 10.0
#: Nodes of a worker's trie, some 200 bytes each, before it is built anew.
TRIE_NODES = 1_000_000
#: Depth of the trie. Pre-tokens that are longer are rare and share no more with others; below, their forward scores are kept in
#: a window as long as the longest piece.
TRIE_DEPTH = 256
#: Distinct words whose counts a worker remembers, none longer than the trie is deep, and their bytes.
WORD_CACHE, CACHE_BYTES = 500_000, 32_000_000
START = "\u2581"


def unigram_scores(path: str = MODEL) -> dict[str, float]:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [
        model.id_to_piece(i) for i in range(model.get_piece_size())
        if not (model.is_unknown(i) or model.is_control(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / (k + 1) for k in range(len(names))))
    return {name: -math.log(k + 1) - total for k, name in enumerate(names)}


class TokenTrie:
    """A node per prefix of a pre-token with its forward score, the best sum over segmentations of the prefix, and
    the number of tokens of that segmentation; at the node where a pre-token ends this is its token count.

    The trie ends at ``depth``; the rest of a longer pre-token is scored in memory that does not depend on its length."""

    def __init__(self, scores: dict[str, float], nodes: int = TRIE_NODES, depth: int = TRIE_DEPTH):
        self.scores = scores
        self.longest = max(map(len, scores), default=1)
        self.byte = min(scores.values(), default=0.0) - BYTE_PENALTY
        self.nodes, self.depth = nodes, depth
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.forward = array("d", [0.0])
        self.tokens = array("q", [0])

    def count(self, word: str) -> int:
        if len(self.children) > self.nodes:
            self.clear()
        forward, tokens = self.forward, self.tokens
        node, path = 0, [0]
        for end, char in enumerate(word[:self.depth], 1):
            child = self.children[node].get(char)
            if child is None:
                child = self.children[node][char] = len(self.children)
                self._extend(word, end, path, 0, forward, tokens)
                self.children.append({})
            node = child
            path.append(node)
        if len(word) <= self.depth:
            return tokens[node]
        path = path[-self.longest:]
        first = self.depth + 1 - len(path)
        forward, tokens = array("d", [forward[n] for n in path]), array("q", [tokens[n] for n in path])
        for end in range(self.depth + 1, len(word) + 1):
            self._extend(word, end, range(len(tokens)), first, forward, tokens)
            if len(tokens) > 64 * self.longest:
                first = end + 1 - self.longest
                del forward[:-self.longest], tokens[:-self.longest]
        return tokens[-1]

    def _extend(self, word: str, end: int, path: Sequence[int], first: int, forward: array, tokens: array) -> None:
        """Append the score and tokens of ``word[:end]``; those of shorter prefixes stand at ``path``, which begins with the
        prefix of ``first`` characters."""
        scores = self.scores
        spelled = len(word[end - 1].encode("utf-8", "surrogatepass"))
        before = path[end - 1 - first]
        best, fewest = forward[before] + spelled * self.byte, tokens[before] + spelled
        for start in range(max(first, end - self.longest), end):
            score = scores.get(word[start:end])
            if score is not None:
                before = path[start - first]
                score += forward[before]
                if score > best or score == best and tokens[before] < fewest - 1:
                    best, fewest = score, tokens[before] + 1
        forward.append(best)
        tokens.append(fewest)


class WordCounts(dict):
    """Token count of each distinct pre-token, from the trie."""

    def __init__(self, trie: TokenTrie):
        super().__init__()
        self.trie, self.bytes = trie, 0

    def __missing__(self, word: bytes) -> int:
        count = self.trie.count(START + word.decode("utf-8", "surrogatepass"))
        if len(word) <= self.trie.depth:
            if len(self) >= WORD_CACHE or self.bytes >= CACHE_BYTES:
                self.clear()
                self.bytes = 0
            self[word] = count
            self.bytes += len(word)
        return count


def word_counts(model: str) -> WordCounts:
    return WordCounts(TokenTrie(unigram_scores(model)))


def token_counts(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``; other columns are ignored) ``doc_id, n_pretokens, n_tokens``.

    Pre-tokens are runs of characters other than U+0020 and U+0009 to U+000D behind a word mark, case kept. A null or
    empty text has none of either; a pre-token of any length is counted whole. Each row is counted by itself, so repeated rows give repeated results; an empty
    table gives none. A worker's trie and its words are dropped at a fixed size and built anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = held(word_counts, model)
        for batch in batches:
            ids, words_in, tokens_in = [], [], []
            for doc, text in rows_in(batch, "doc_id", "text"):
                words = text.encode("utf-8", "surrogatepass").split() if text else []
                ids.append(doc)
                words_in.append(len(words))
                tokens_in.append(sum(map(counts.__getitem__, words)))
            yield pa.record_batch(
                [pa.array(x, pa.int64()) for x in (ids, words_in, tokens_in)], names=["doc_id", "n_pretokens", "n_tokens"])

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return map_batches(rows, run, "doc_id bigint, n_pretokens bigint, n_tokens bigint")
