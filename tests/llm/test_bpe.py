import base64
import hashlib
import random

import public_tokenizers
import pyarrow as pa
import tiktoken
from llm_helpers import LONG, ODD, table

from gradewell.llm.bpe import codec, decode, encode

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_equals_the_library_on_random_texts():
    draw = random.Random(3)
    letters = "ab 1'stmdrevl \n\t.!é世 ²٣\U0001f600"
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(0, 40))) for _ in range(5000)]
    texts += ["", "'", " ", "  ", "a" * 3000, "." * 999 + "x", " '" * 300, "<|endoftext|>", LONG]
    own, other = codec(PATH), library()
    for text, (ids, at, parts) in zip(texts, own.encode(pa.array(texts)), strict=True):
        assert list(map(int, ids.split())) == other.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()
        data = text.encode()
        assert [own.decode(p) for p in parts] == [data[a:b] for a, b in zip(at, at[1:], strict=False)]


def test_odd_rows_and_round_trip(spark):
    rows = encode(table(spark), PATH, keep_ids=True)
    got = sorted(((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows.collect()), key=str)
    other, want = library(), []
    for i, t in ODD:
        ids = other.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    texts = sorted(((r.doc_id, r.text) for r in decode(rows, PATH).collect()), key=str)
    assert texts == sorted(((i, t or "") for i, t in ODD), key=str)


def test_empty_table(spark):
    assert encode(table(spark, []), PATH).count() == 0
