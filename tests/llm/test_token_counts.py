import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from sieveline.llm import token_counts
from tests.llm.corpus import frame, texts

BYTES, WORDS, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))
PARTS = ["a", "b ", "  ", "\n", " \n", "'s", "'re ", "<|endoftext|>", " <|endoftext|> ", "　", "  ", "漢", "。", "1", "23 ", "!?", "\xa0 ", "\t", "é ", "\x85 ", "​ ", "\x1c "]


def library(text: str, path: str = BYTES) -> int:
    return len(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids)


@pytest.mark.parametrize("most", [5, 40])
def test_pieces_have_the_tokens_of_the_whole(most):
    counter, tokenizer, rng = token_counts.Counter.of(BYTES), Tokenizer.from_file(BYTES), random.Random(most)
    whole = ["".join(rng.choices(PARTS, k=rng.randint(0, 50))) for _ in range(1500)]
    got = list(token_counts.batched_counts(counter, (t.encode() for t in whole), most))
    assert got == [len(tokenizer.encode(t, add_special_tokens=False).ids) for t in whole]


def test_batches_are_bounded_by_bytes():
    """Whatever the length of a text, the tokenizer never gets more than a batch."""
    counter = token_counts.Counter.of(BYTES)
    sizes, count = [], counter.count

    class Watched:
        cuts, special = True, counter.special

        def count(self, batch):
            sizes.append(sum(len(t.encode()) for t in batch))
            return count(batch)

    whole = ["word in a text. " * 20_000, "short", "", "x " * 50_000]
    got = list(token_counts.batched_counts(Watched(), (t.encode() for t in whole), 10_000))
    assert max(sizes) <= 10_000 and sum(sizes) == sum(map(len, whole)) and got == [library(t) for t in whole]


def test_counts_equal_the_library(spark):
    rows = texts() + [(20, "x <|endoftext|> y<|endoftext|>", "en"), (21, "日本語" * 9000, "ja")]
    got = token_counts.count(frame(spark, rows), BYTES, batch_bytes=5000, limit=100).collect()
    want = [(i, len((t or "").encode()), n := library(t or ""), n > 100) for i, t, _ in rows]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_other_tokenizers_count_whole_texts(spark):
    import sentencepiece

    rows = [(1, "Some words,  and more.", None), (2, None, None), (3, "", None)]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count(frame(spark, rows), PIECES).collect()}
    assert got == {1: len(model.encode(rows[0][1])), 2: 0, 3: 0}
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count(frame(spark, rows), WORDS).collect()}
    assert got == {1: library(rows[0][1], WORDS), 2: 0, 3: 0}


def test_empty_table_and_columns(spark):
    empty = token_counts.count(frame(spark, texts()).where("false"), BYTES)
    assert empty.collect() == [] and [f.simpleString() for f in empty.schema] == ["doc_id:bigint", "n_bytes:bigint", "n_tokens:bigint", "over_limit:boolean"]
