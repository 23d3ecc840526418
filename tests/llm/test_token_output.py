import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.brute import ODD_TEXTS
from waybill.llm import repair, token_output

PARTS = ["a", "bb", " ", "  ", "\n", "\n\n", "\t", "é", "$", "'s", "1", "23", " 漢字 ", "\x0b", "\x1c", "\xa0", "　",
         "Z", "don't", "<|endoftext|>", " x", "\r\n", "\x85", ".", "!!", "word,"]


def odd(count, seed):
    random = np.random.default_rng(seed)
    return ["".join(random.choice(PARTS, random.integers(0, 60))) for _ in range(count)]


def plain_ids(texts):
    encoder = token_output.Encoder(token_output.TOKENIZER)
    return [x.ids for x in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_chunks_give_the_tokenizers_ids(monkeypatch):
    texts = odd(1500, 1) + [t or "" for t in ODD_TEXTS]
    encoder = token_output.Encoder(token_output.TOKENIZER)
    got = [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder.encode(texts)]
    assert got == plain_ids(texts)
    monkeypatch.setattr(token_output, "KEPT_CHUNKS", 50)
    got = [np.frombuffer(x, dtype="<u4").tolist() for i in range(0, 1500, 7) for x in encoder.encode(texts[i : i + 7])]
    assert got[:1500] == plain_ids(texts[:1500])


def test_another_tokenizer_is_used_whole():
    encoder = token_output.Encoder("word_bpe_49k.json")
    assert not encoder.by_chunks
    texts = odd(50, 2)
    want = [x.ids for x in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder.encode(texts)] == want


@pytest.mark.parametrize("symbols", [1 << 16, 1 << 31])
def test_grammar_round_trip(symbols):
    random = np.random.default_rng(3)
    for size in (1, 2, 5000):
        ids = np.concatenate([np.zeros(size // 2, dtype=np.uint32), random.zipf(1.3, size).astype(np.uint32) % 50000])
        firsts = random.random(len(ids)) < 0.01
        firsts[0] = True
        packed, kept, rules = repair.compress(ids, firsts, 50257, symbols)
        lengths = repair.expansion_lengths(rules, 50257)
        decoder = repair.Decoder(rules, lengths, 50257)
        assert (decoder.decode(packed) == ids).all() and kept.sum() == firsts.sum()
        # Each document begins with a whole symbol of its own.
        begins = np.cumsum(decoder.lengths[packed]) - decoder.lengths[packed]
        assert (begins[kept] == np.flatnonzero(firsts)).all()
        assert len(rules) == 0 or len(packed) < len(ids)
        if size == 5000:
            assert (decoder.part(packed, 37, 4011) == ids[37:4011]).all()
            assert (decoder.part(packed, 0, len(ids)) == ids).all()


def test_round_trip(spark, tmp_path, monkeypatch):
    texts = odd(120, 4) + ODD_TEXTS + ["long " * 30000]
    rows = [(3 * i - 50, t) for i, t in enumerate(texts)] + [(None, "no id"), (7, "repeated id"), (7, "repeated id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"draw": F.lit(1), "start": F.lit("s")})
    path = str(tmp_path / "tokens")
    token_output.write_tokens(docs.orderBy(F.rand(5)).repartition(6), path)
    back = token_output.read_tokens(spark, path)
    got = [tuple(r) for r in token_output.digests(back).orderBy("start").collect()]
    ids = {}
    for (i, _), x in zip(rows, plain_ids([t for _, t in rows]), strict=True):
        ids.setdefault(i, []).append(x + [token_output.END_ID])
    start = 0
    assert [r[0] for r in got] == sorted(ids, key=lambda i: (i is not None, i or 0)) if len(ids) == len(got) else True
    assert [r[0] for r in got if r[0] is not None] == sorted(i for i, _ in rows if i is not None)
    for doc_id, begin, n, crc in got:
        match = [x for x in ids[doc_id] if zlib.crc32(np.array(x, dtype="<u4").tobytes()) == crc]
        assert begin == start and match and n == len(match[0])
        start += n
    assert len(got) == len(rows)


def test_random_access():
    ids = [np.array(x + [2], dtype="<u4") for x in plain_ids(odd(40, 6) * 4)]
    shard = token_output.Shard(token_output._pack(list(range(len(ids))), [x.tobytes() for x in ids], 50257))
    for k in (0, 7, len(ids) - 1):
        assert (shard.document(k) == ids[k]).all()
        assert (shard.part(k, 1, 5) == ids[k][1:5]).all()


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    token_output.write_tokens(docs, str(tmp_path / "none"))
    assert token_output.read_tokens(spark, str(tmp_path / "none")).count() == 0


def test_a_passage_in_many_copies_becomes_few_symbols():
    random = np.random.default_rng(8)
    passage = random.integers(0, 50_000, 1000).astype(np.uint32)
    ids = np.tile(passage, 200)
    firsts = np.zeros(len(ids), dtype=bool)
    firsts[:: len(passage)] = True
    packed, kept, rules = repair.compress(ids, firsts, 50_257, 1 << 16)
    assert len(packed) <= 2 * 200 and kept.sum() == 200
    decoder = repair.Decoder(rules, repair.expansion_lengths(rules, 50_257), 50_257)
    assert (decoder.decode(packed) == ids).all()


def test_no_frequent_pair_is_left():
    random = np.random.default_rng(9)
    ids = (random.zipf(1.2, 60_000) % 400).astype(np.uint32)
    firsts = random.random(len(ids)) < 0.02
    firsts[0] = True
    packed, kept, _ = repair.compress(ids, firsts, 400, 1 << 16)
    pairs = [tuple(p) for p, first in zip(np.stack([packed[:-1], packed[1:]], axis=1).tolist(), kept[1:]) if not first]
    apart = {}
    for k, pair in enumerate(pairs):
        apart.setdefault(pair, []).append(k)
    assert max(len(places) for places in apart.values()) < 2 * repair.LEAST_COUNT


def test_chunks_that_come_again_are_encoded_once(monkeypatch):
    monkeypatch.setattr(token_output, "KEPT_CHUNKS", 50)
    encoder, given = token_output.Encoder(token_output.TOKENIZER), []
    plain = encoder._encode
    monkeypatch.setattr(encoder, "_encode", lambda texts: given.extend(texts) or plain(texts))
    texts = [f"evergreen passage {' '.join(f'n{i}x{k}' for k in range(20))} evergreen" for i in range(30)]
    got = [np.frombuffer(ids, dtype="<u4").tolist() for text in texts for ids in encoder.encode([text])]
    assert got == plain_ids(texts)
    assert len(encoder.hashes) <= 50
    # At the start of a text and after a space.
    assert " ".join(given).count("evergreen") == 2 and " ".join(given).count("passage") == 1


def test_a_tokenizer_without_some_bytes(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    letters = sorted(set(pre_tokenizers.ByteLevel.alphabet()) - set("zé"))
    own = Tokenizer(models.BPE(vocab={letter: k for k, letter in enumerate([*letters, "ab"])}, merges=[("a", "b")]))
    own.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    own.save(str(tmp_path / "own.json"))
    texts = ["ab zab zz ab\nz ab, z.", "z", *odd(50, 10)]
    want = [x.ids for x in own.encode_batch(texts, add_special_tokens=False)]
    encoder = token_output.Encoder(str(tmp_path / "own.json"))
    assert [np.frombuffer(ids, dtype="<u4").tolist() for ids in encoder.encode(texts)] == want


def test_late_rounds_count_only_what_has_changed(monkeypatch):
    random = np.random.default_rng(11)
    passage, noise = random.integers(0, 50_000, 1024), random.integers(0, 50_000, 60_000)
    ids = np.concatenate([np.concatenate([part, passage]) for part in np.split(noise, 10)]).astype(np.uint32)
    firsts = random.random(len(ids)) < 0.001
    firsts[0] = True
    counted, rules_of = [], repair._rules
    monkeypatch.setattr(repair, "_rules", lambda pairs, *rest: counted.append(len(pairs)) or rules_of(pairs, *rest))
    packed, kept, rules = repair.compress(ids, firsts, 50_257, 1 << 16)
    assert len(counted) >= 8 and sum(counted) < 2 * len(ids)
    # The same grammar as with all pairs counted in every round.
    monkeypatch.setattr(repair, "_rules", lambda *given: (*rules_of(*given)[:3], False))
    for got, want in zip((packed, kept, rules), repair.compress(ids, firsts, 50_257, 1 << 16), strict=True):
        assert (got == want).all()
