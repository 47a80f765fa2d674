import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from llm_helpers import LONG, ODD, table
from tokenizers import Tokenizer

from gradewell.llm import packing
from gradewell.llm.packing import best_fit, best_fit_packing, tokenise

PATH = public_tokenizers.path("word_bpe_49k.json")


def ids_of(text):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [*t.encode(text or "", add_special_tokens=False).ids, 1]


def test_pieces_are_the_tokenizers_ids(spark):
    rows = [*ODD, (20, "It's DON'T, x.y... İstanbul ΣΑΣ ﬁ é <|endoftext|> 12 3,4 a b\u0085c"), (21, LONG * 3)]
    got = defaultdict(list)
    for r in tokenise(table(spark, rows), PATH, 512, keep_ids=True).collect():
        got[r.doc_id].append(r)
    for doc in {i for i, _ in rows}:
        want = sorted(tuple(ids_of(t)) for i, t in rows if i == doc)
        pieces = sorted(got[doc], key=lambda r: (r.piece, r.ids_crc32))
        whole = [tuple(x for r in pieces for x in r.ids)] if len(want) == 1 else want
        if len(want) == 1:
            assert whole == want
            assert [r.start for r in pieces] == [512 * r.piece for r in pieces]
        for r in pieces:
            assert r.length == len(r.ids) <= 512
            assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())


def test_signs_after_letters_reach_the_tokenizer_only_as_runs(monkeypatch):
    encoder = packing.Encoder(PATH)
    texts = ["fox fox, fox.*** übel### éa', x€!! 3,4. don't.' e\u0301!! !!! a.b. fox's Σ.", "fox### übel, ($$$ Fox$$$ €"]
    sent = []

    class Counted:
        model = encoder.tokenizer.model

        def encode_batch_fast(self, words, **options):
            sent.extend(words)
            return inner.encode_batch_fast(words, **options)

    inner, encoder.tokenizer = encoder.tokenizer, Counted()
    got = [list(np.frombuffer(b, "<u4")) for b in encoder.ids([t.encode() for t in texts])]
    assert got == [ids_of(t)[:-1] for t in texts]
    assert not {w for w in sent if w[0] in "fü" and not w.isalpha() and "'s" not in w}


def test_a_full_cache_keeps_the_words_of_the_batch(monkeypatch):
    monkeypatch.setattr(packing, "CACHE", 6)
    encoder = packing.Encoder(PATH)
    texts = ["the cat sat on", "the cat had one two.", "the end of it all, the cat!"]
    for t in texts:
        assert [list(np.frombuffer(b, "<u4")) for b in encoder.ids([t.encode()])] == [ids_of(t)[:-1]]
        assert b"the" in encoder.known
    assert b"sat" not in encoder.known


def test_sequences_are_gapless_and_full(spark):
    rows = [(i, " ".join(f"word{j}" for j in range(i % 37 + 1))) for i in range(400)]
    filled = defaultdict(list)
    total = 0
    for r in best_fit_packing(table(spark, rows), PATH, 256).collect():
        filled[r.sequence_id].append((r.offset, r.length))
        total += r.length
    for parts in filled.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 256
    assert len(filled) <= 1.05 * total / 256 + 2


def test_repeated_rows_spread_over_tasks_and_keep_their_places(spark, monkeypatch):
    monkeypatch.setattr(packing, "TASK_ROWS", 100)
    docs = table(spark, [(None, "")] * 700 + [(i, f"one word {i}") for i in range(300)])
    pieces = packing.pin(tokenise(docs, PATH, 64))
    packed = packing.pack(pieces, 64)
    rows = packed.collect()
    tasks = Counter(r.sequence_id >> 40 for r in rows)
    assert len(rows) == 1000 and len(tasks) == 10 and max(tasks.values()) < 160
    again = packing.pack(pieces, 64).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))


def test_fullest_bin_closes_first():
    bins, offsets = best_fit([60, 50, 70, 35, 30], 100, 2)
    # 70 finds two open bins with 40 and 50 free: the one with 40 closes.
    assert bins == [0, 1, 2, 1, 2] and offsets == [0, 0, 0, 50, 70]


def test_empty_table(spark):
    assert best_fit_packing(table(spark, []), PATH).count() == 0
