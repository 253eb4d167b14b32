"""What Python workers hold after their tasks: Spark keeps them while other stages run."""

import pandas as pd

from airshed.llm import minhash, packing
from airshed.session import ship_package


def held(spark):
    """Words that packing and hashes that minhash remember, at most, in any worker."""
    def run(batches):
        for batch in batches:
            words = max((e.numbers.known for e in packing._ENCODERS.values()), default=0)
            yield pd.DataFrame({"words": [words] * len(batch), "hashes": [len(minhash._HASHES)] * len(batch)})

    rows = spark.range(64, numPartitions=16).mapInPandas(run, "words long, hashes long")
    return tuple(rows.agg({"words": "max", "hashes": "max"}).select("max(words)", "max(hashes)").first())


def test_workers_forget_words(spark):
    ship_package(spark)
    docs = spark.range(200, numPartitions=8).selectExpr(
        "id as doc_id", "concat_ws(' ', transform(sequence(1, 50), x -> concat('w', id % 20, 'x', x))) as text")
    assert packing.pack(docs).agg({"length": "sum"}).first()[0] > 0
    assert minhash.link_documents(docs).filter("kept").count() == 20
    assert held(spark) == (0, 0)
