"""BPE against the tokenizers library; streaming with tiny windows; the byte-to-text machine."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from govlake.llm.bpe import Decoder, Encoder, IdsToText, Vocabulary, encode_documents, merge, sufficient_lookahead
from govlake.llm.queries import op3_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(PATH)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(encoder, text):
    return np.frombuffer(b"".join(encoder.encode(text)), "<u4").tolist()


def strange_texts():
    rng = random.Random(4)
    out = ["", " ", "a", "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "it's we'll I'd", "  a  \n\n b\t", "\x1c\x1f\x85 x",
           "é​　d 😀😀\r\n", "a" * 5000, "-" * 20001, " " * 9000, "ÃÂ" * 4000, "x y " * 60_000]
    letters = [*"ab '\n1-=_éñ中😀 Âà", "the", "ing", "'s", " of"]
    out += ["".join(rng.choices(letters, k=rng.randint(1, 200))) for _ in range(300)]
    out += ["".join(rng.choices("ÂÃab-=_*", k=9000)) for _ in range(4)]
    return out


def test_equals_the_library(vocab, library):
    encoder, decoder = Encoder(vocab), Decoder(vocab)
    texts = strange_texts()
    for text, want in zip(texts, library.encode_batch(texts, add_special_tokens=False)):
        got = ids(encoder, text)
        assert got == want.ids
        assert "".join(decoder.decode([np.array(got, "<u4").tobytes()])) == text == library.decode(want.ids, skip_special_tokens=False)


def test_window_of_lookahead_is_enough(vocab):
    """Pieces longer than the window are the same as merged whole."""
    rng = random.Random(6)
    longest = [t for t in vocab.text if len(t) > 4 and b" " not in t]
    encoder = Encoder(vocab, window=1)
    assert encoder.window == 2 * vocab.lookahead
    for _ in range(15):
        data = b"".join(rng.choices(longest, k=900))
        whole = merge([vocab.of_byte[b] for b in data], vocab.rank)
        parts = [data[i:i + 50] for i in range(0, len(data), 50)]
        assert [t for out in encoder.transduce(parts) for t in out] == whole


def test_many_windows_at_once_equal_one_by_one(vocab):
    rng = random.Random(9)
    windows = [bytes(rng.choices(b"abcdeinorst- ", k=rng.randint(1, 40))) for _ in range(3000)] + [b"a" * n for n in range(1, 65)] + [bytes([b]) for b in range(256)]
    for w, got in zip(windows, vocab.windows.merge(windows)):
        assert np.frombuffer(got, "<u4").tolist() == merge([vocab.of_byte[b] for b in w], vocab.rank)


def test_lookahead_of_small_merge_lists():
    assert sufficient_lookahead([(b"a", b"b")]) == 1
    # b c is merged before a b, so whether a takes b depends on one byte after it
    assert sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2


def test_random_small_vocabularies_need_no_more_than_their_lookahead():
    rng = random.Random(8)
    for _ in range(60):
        tokens = [b"a", b"b", b"c"]
        merges = []
        for _ in range(12):
            a, b = rng.choice(tokens), rng.choice(tokens)
            if a + b not in tokens and len(a + b) <= 8:
                merges.append((a, b))
                tokens.append(a + b)
        number = {t: i for i, t in enumerate(tokens)}
        rank = {(number[a], number[b]): (i, number[a + b]) for i, (a, b) in enumerate(merges)}
        reach = sufficient_lookahead(merges) if merges else 0
        for _ in range(30):
            data = bytes(rng.choices(b"abc", k=60))
            whole = merge([number[data[i:i + 1]] for i in range(60)], rank)
            cut = rng.randint(10, 59)
            part = merge([number[data[i:i + 1]] for i in range(cut)], rank)
            at = 0
            for t, u in zip(whole, part):
                if at + len(tokens[u]) + reach > cut:
                    break
                assert t == u
                at += len(tokens[u])


def test_machine_holds_back_incomplete_characters():
    data = "é中😀a".encode() + b"\xff" + "é".encode()[:1]
    machine = IdsToText([bytes([b]) for b in range(256)])
    assert "".join(machine.feed(data[i].to_bytes(4, "little")) for i in range(len(data))) + machine.close() == data.decode("utf-8", "replace")


def test_documents(odd_docs, make_docs, rows_of, texts_of, library):
    out = rows_of(encode_documents(odd_docs, PATH))
    assert sorted(map(repr, ((r["doc_id"], r["decoded"]) for r in out))) == sorted(map(repr, ((i, t or "") for i, t in texts_of(odd_docs))))
    for r in out:
        want = library.encode(r["decoded"], add_special_tokens=False).ids
        assert r["n_tokens"] == len(want) and bytes(r["token_ids"]) == np.array(want, "<u4").tobytes()
    assert encode_documents(make_docs([]), PATH).count() == 0


def test_query(spark, library):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in op3_bpe(spark, "/root/testdata/sf0.001").collect():
        want = library.encode(docs[r["doc_id"]], add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want), hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(docs[r["doc_id"]].encode()).hexdigest()
