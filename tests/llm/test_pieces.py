import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece
from llm_cases import ODD

from gridmill.llm import pieces
from gridmill.llm.units import Store

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


def by_hand(library, text):
    ids = library.encode(text or "", add_bos=False, add_eos=True)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))


def test_whole_table_matches_the_library(spark, sf, library):
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = {r[0]: tuple(r)[1:] for r in pieces.op7_sentencepiece(spark, sf).collect()}
    assert got == {d: by_hand(library, t) for d, t in texts.items()}


def test_odd_texts(odd_docs, no_docs, library):
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in pieces.encoded(odd_docs, PATH).collect()}
    assert got == {i: by_hand(library, t) for i, t in enumerate(ODD)}
    assert pieces.encoded(no_docs, PATH).count() == 0
    row = pieces.encoded(odd_docs, PATH, with_ids=True).filter("doc_id = 7").first()
    assert row.ids == library.encode(ODD[7], add_eos=True) and row.decoded == ODD[7]


def test_random_strings_and_a_small_store(library):
    m = pieces.Model(PATH)
    kept = Store(m, most=50)
    rng = random.Random(3)
    letters = list("abeth ▁nrs日é\n\t.,'0123<>😀") + ["  ", " the", "�", "‍"]
    for _ in range(400):
        text = "".join(rng.choices(letters, k=rng.choice([1, 3, 10, 60, 300])))
        units = m.units(text)
        assert library.encode(text) == [int(i) for v in kept.of_units(units) for i in v[1].split()]
        for u in units:
            for p in m.parts(u):
                assert m.merged(p) == m._merged_long(p)


def test_other_models_are_refused(tmp_path):
    with pytest.raises(Exception):
        pieces.Model(str(tmp_path / "none.model"))
