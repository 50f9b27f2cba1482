import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from helixframe.llm import tokens

PATH = P.path("word_bpe_49k.json")


def want(rows):
    t = Tokenizer.from_file(PATH)
    return sorted(
        ((i, len((x or "").encode()), n := len(t.encode(x or "", add_special_tokens=False).ids), n > 2048) for i, x in rows), key=str
    )


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_counts_are_the_librarys(spark, edge_docs, edge_rows):
    assert got(tokens.count_tokens(edge_docs, PATH)) == want(edge_rows)


def test_query_on_the_table(spark, sf, sf_docs):
    assert got(tokens.op1_token_counts(spark, sf)) == want(sf_docs)


def test_the_cache_takes_only_misses(spark, tmp_path):
    cache = str(tmp_path / "cache")
    one = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "c")], "doc_id long, text string")
    first = got(tokens.count_tokens(one, PATH, cache))
    assert spark.read.parquet(cache).count() == 2  # equal when normalised
    more = one.unionByName(spark.createDataFrame([(4, "d e f")], one.schema))
    assert got(tokens.count_tokens(more, PATH, cache))[:3] == first
    assert spark.read.parquet(cache).count() == 3


def test_a_warm_cache_moves_only_missing_texts(spark, tmp_path, monkeypatch, edge_docs, edge_rows):
    cache, moved = str(tmp_path / "cache"), []
    split = tokens.split_by

    def watched(docs, found, keys):
        out = split(docs, found, keys)
        moved.append(out[1].count())
        return out

    monkeypatch.setattr(tokens, "split_by", watched)
    assert got(tokens.count_tokens(edge_docs, PATH, cache)) == want(edge_rows) and not moved
    more = edge_rows + [(50, "new text"), (51, "new  text"), (None, None)]
    docs = spark.createDataFrame(more, "doc_id long, text string")
    assert got(tokens.count_tokens(docs, PATH, cache)) == want(more) and moved == [2]
    assert got(tokens.count_tokens(docs, PATH, cache)) == want(more) and moved == [2, 0]


def test_empty_table_and_other_tokenizers(no_docs):
    assert tokens.count_tokens(no_docs, PATH).count() == 0
    with pytest.raises(ValueError, match="white space"):
        tokens.count_tokens(no_docs, P.path("byte_bpe_50k.json"))
