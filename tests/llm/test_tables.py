"""What Python workers keep from task to task."""

import gc

import public_tokenizers
import pytest

from carrack.llm import bloom, langid, packing, shingles, tables

@pytest.fixture
def alive():
    """A function that workers get by value."""

    def found(_batch):
        gc.collect()
        kept = ("_Scorer", "WordEncoder", "PieceModel", "_Words")
        yield {"found": [sum(type(x).__name__ in kept for x in gc.get_objects())]}

    return found


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, f"words of the text number {n} and some more of them", "xy"[n % 2]) for n in range(320)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(32).localCheckpoint()


def test_workers_forget_what_other_work_has_kept(docs, alive):
    """Workers are used again: a scorer, an encoder and the hashes of words would add up in each."""
    langid.identified(docs, langid.fit(docs)).write.format("noop").mode("overwrite").save()
    packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).write.format("noop").mode("overwrite").save()
    shingles.without_near_duplicates(docs).write.format("noop").mode("overwrite").save()
    packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")).write.format("noop").mode("overwrite").save()
    found = tables.map_batches(docs, alive, "found int").collect()
    assert len(found) >= 32
    assert not any(r.found for r in found)


def test_a_filter_forgets_too(docs, alive):
    def keys_of(batch):
        for row in alive(batch):
            assert row["found"] == [0]
        yield from ()

    langid.identified(docs, langid.fit(docs)).write.format("noop").mode("overwrite").save()
    assert not bloom.twice_seen(docs.select("text"), keys_of, 10).any()


def test_what_the_same_work_keeps_is_made_once():
    made = []
    try:
        for _ in range(2):
            tables.forget("a")
            assert tables.remember("a", lambda: made.append(1) or made) is made
        tables.remember("b", list)
        tables.remember("a", lambda: made.append(1) or made)
        assert len(made) == 2
    finally:
        tables.forget()
