import hashlib
import random

import numpy as np
import pytest

from weir.llm import bpe

pytest.importorskip("public_tokenizers")
VOCAB = bpe.vocabulary()


def lib():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(VOCAB)


def expected(text):
    t = lib()
    ids = t.encode(text or "", add_special_tokens=False).ids
    return len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()


ALPHABETS = ["ab", "abc '", "thea n's12!", "aéßÿ .", "x", "<|endoftext|> a", "ΣσΌ é́a", "!?'", "中文字 a", "tion ing er\n\t"]


@pytest.mark.parametrize("alphabet", ALPHABETS)
def test_strings_and_tree_match_the_library(alphabet):
    rnd, c, t = random.Random(1), bpe.codec(VOCAB), lib()
    for n in [0, 1, 2, 5, 30, 200, 700]:
        for _ in range(4):
            text = "".join(rnd.choice(alphabet) for _ in range(n))
            want = t.encode(text, add_special_tokens=False).ids
            k, ids, toks = c.strings(text)
            assert [int(i) for i in ids.split()] == want and k == len(want)
            assert toks == t.decode(want, skip_special_tokens=False)
            if any(s in text for s in c.special):
                continue
            norm = c.normal(text)
            for size in (7, 40, 150):
                pieces = [norm[i : i + size] for i in range(0, len(norm), size)]
                assert c.tree(pieces, [c.encode_normal(p) for p in pieces]).tolist() == want


def test_documents(spark):
    long = "".join(random.Random(3).choice("thea n's1!é") for _ in range(3000))
    texts = [None, "", "   ", "It's", "x" * 500, long, long, "a<|endoftext|>b " * 40, long + "<|startoftext|>" + long, "ΌΣ " * 100, "\x1c\x85  a" * 30]
    df = spark.createDataFrame([(i if i else None, x, "z") for i, x in enumerate(texts)], "doc_id long, text string, n_tokens string")
    got = bpe.encode(df.drop("n_tokens"), VOCAB, piece_chars=100, texts=True).collect()
    assert len(got) == len(texts)
    for r in got:
        text = texts[r.doc_id or 0]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == expected(text)
        assert hashlib.sha256(bpe.decode(np.array(r.ids, int), VOCAB).encode()).hexdigest() == r.decoded_sha256
    assert bpe.encode(df.limit(0), VOCAB).count() == 0


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", 2, 3, 4)], "doc_id long, text string, n_tokens int, spans int, rid int")
    with pytest.raises(ValueError):
        bpe.encode(df, bpe.vocabulary(), carry=("doc_id", "n_tokens"))
    assert bpe.encode(df, bpe.vocabulary()).count() == 1
