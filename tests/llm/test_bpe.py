import hashlib
import random
import struct

import public_tokenizers as P
import pytest
from fixtures import SF, awkward, empty
from tokenizers import Tokenizer

from ridestar.llm.bpe import Bpe, encode_column, token_digests
from ridestar.llm.split import units

PATH = P.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_padding()
    t.no_truncation()
    return t


def unpack(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


def hard_texts():
    rng = random.Random(5)
    letters = " \n\t aé1'sdt.<|>\x1c​ 　"
    fixed = ["", " ", "\n", "a  b", "a\n b", "<|endoftext|>", " <|endoftext|>\n", "'s\n's", "\r\n x", "½ Ⅷ",
             "a" * 3000, "ab " * 3000, "\U0001F468‍\U0001F469"]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 25))) for _ in range(3000)]


def test_ids_and_text_equal_the_library(library):
    bpe, texts = Bpe(PATH), hard_texts()
    ids = [unpack(p) for p in bpe.encode(texts)]
    assert ids == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [bpe.decode(i) for i in ids] == [library.decode(i, skip_special_tokens=False) for i in ids]
    assert [bpe.decode(i) for i in ids] == texts


def test_units_give_the_text_back():
    for t in hard_texts():
        assert "".join(units(t)) == t


def test_broken_bytes_decode_like_the_library(library):
    bpe, rng = Bpe(PATH), random.Random(2)
    for _ in range(300):
        ids = [rng.randrange(256) for _ in range(rng.randint(1, 8))]
        assert bpe.decode(ids) == library.decode(ids, skip_special_tokens=False)


def digest_rows(library, rows):
    out = []
    for doc_id, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        out.append((doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                    hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def test_digests_over_a_table(spark, library):
    for df in (awkward(spark), spark.read.parquet(f"{SF}/documents.parquet")):
        rows = [(r.doc_id, r.text) for r in df.collect()]
        assert sorted(map(tuple, token_digests(df, PATH).collect()), key=str) == digest_rows(library, rows)


def test_empty_table_and_clashing_columns(spark):
    assert token_digests(empty(spark), PATH).count() == 0
    df = awkward(spark, "1 as n_tokens;'x' as ids_sha256")
    assert token_digests(df, PATH).count() == df.count()
    assert encode_column(df, PATH).columns == [*df.columns, "ids"]
    with pytest.raises(ValueError):
        encode_column(df, PATH, into="N_TOKENS")


def test_long_text(library):
    text = "".join(random.Random(1).choice("abcde  \n") for _ in range(1_000_000))
    assert unpack(Bpe(PATH).encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
