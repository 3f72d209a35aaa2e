from riskflow.operators.report import with_report
from riskflow.operators.score import flat_result, score
from riskflow.sources.views import DIABETES_KEY, diabetes_from, diabetes_records, table
from riskflow.streaming.score import score_available


def _rows(df, columns):
    return sorted(tuple(row) for row in df.select(*columns).collect())


def test_stream_equals_batch_and_counts_each_file_once(spark, sf_dir, tmp_path):
    lineitem = table(spark, sf_dir, "lineitem")
    source, sink, checkpoint = (str(tmp_path / name) for name in ("in", "out", "log"))

    def arrive():
        return score_available(
            spark, source, lineitem.schema, diabetes_from, "diabetes",
            list(DIABETES_KEY), sink, checkpoint,
        )

    lineitem.filter("l_orderkey % 2 = 0").repartition(3).write.parquet(source)
    first = arrive().count()
    assert first == lineitem.filter("l_orderkey % 2 = 0").count()
    lineitem.filter("l_orderkey % 2 = 1").write.mode("append").parquet(source)
    arrive()
    streamed = arrive()
    batch = with_report(
        flat_result(score(diabetes_records(spark, sf_dir), "diabetes"), *DIABETES_KEY), "diabetes"
    )
    columns = [*DIABETES_KEY, "probability", "prediction", "message"]
    assert _rows(streamed, columns) == _rows(batch, columns)
