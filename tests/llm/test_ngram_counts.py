"""The counts of all n-grams on their way to the tasks."""

from pyspark.serializers import CloudPickleSerializer
from pyspark.sql import DataFrame

from cinetally.llm import ngram_join


def test_counts_of_ngrams_are_no_part_of_a_function(spark, monkeypatch):
    sizes, mapped = [], DataFrame.mapInArrow
    for kind in {DataFrame, type(spark.range(1))}:
        plain = kind.__dict__.get("mapInArrow", mapped)
        monkeypatch.setattr(kind, "mapInArrow", lambda self, f, schema, plain=plain: sizes.append(len(CloudPickleSerializer().dumps(f))) or plain(self, f, schema))
    docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, "x y")], "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in ngram_join.link(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    assert sizes and max(sizes) < 1 << 20
