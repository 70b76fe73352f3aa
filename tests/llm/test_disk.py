"""What an operator has stored and shuffled on the way goes when it is no longer needed."""

from stratamart.llm import common, jaccard
from stratamart.operators import folders

RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_prefixes_are_gone_before_blocks_are_compared(spark, monkeypatch):
    text = " ".join(f"w{i}" for i in range(60))
    docs = spark.createDataFrame(
        [(1, text), (2, text + " more"), (3, "other words entirely here now"), (4, None)],
        "doc_id long, text string",
    )
    places, seen = {}, []
    across = jaccard._across

    def keep(df, purpose):
        path = common.scratch_path(df.sparkSession, purpose)
        places[purpose] = path
        df.write.parquet(path)
        common._intermediates[-1].append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    def watch(*args):
        seen.append((folders.exists(spark, places["jaccard-prefixes"]), spark.conf.get(RELEASED)))
        return across(*args)

    monkeypatch.setattr(jaccard, "stored", keep)
    monkeypatch.setattr(jaccard, "_across", watch)
    found = {r.doc_id: r.component_id for r in jaccard.jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}
    assert seen == [(False, "true")]
    assert not any(folders.exists(spark, p) for p in places.values())
    assert spark.conf.get(RELEASED) == "false"
