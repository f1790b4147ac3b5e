import pytest
from pyspark.errors import StreamingQueryException

from rowloom.errors import DataError
from rowloom.operators.preprocess import PreprocessSpec, fit_preprocessor
from rowloom.operators.row_features import RowFeatures, build_row_features
from rowloom.operators.series_features import SeriesFeatures, build_series_features
from rowloom.streaming import features as streaming


@pytest.fixture
def folder(skewed, tmp_path):
    path = str(tmp_path / "in")
    skewed.repartition(3).write.parquet(path)
    return path


def test_row_features_match_the_batch_result(spark, skewed, folder, tmp_path):
    spec = RowFeatures(["t"], ["v"], {"r": ("v", "series")})
    stream = streaming.stream_row_features(streaming.read_stream(spark, folder, skewed.schema, files_per_trigger=1), spec)
    out = str(tmp_path / "out")
    streaming.append_to(stream, out, str(tmp_path / "progress")).awaitTermination()
    got, want = spark.read.parquet(out), build_row_features(skewed, spec)
    assert got.count() == 3000 and got.exceptAll(want).count() == 0


def test_bad_values_stop_the_stream(spark, skewed, folder, tmp_path):
    negative = streaming.read_stream(spark, folder, skewed.schema).selectExpr("v - 50 as v")
    stream = streaming.stream_row_features(negative, RowFeatures(log1p_columns=["v"]))
    query = streaming.append_to(stream, str(tmp_path / "out"), str(tmp_path / "progress"))
    with pytest.raises(StreamingQueryException, match="feature_log1p_negative_values"):
        query.awaitTermination()


def test_fitted_preprocessor(spark, skewed, folder, tmp_path):
    spec = PreprocessSpec(["v"], ["series"], handle_unknown="error", encoding="sparse")
    fitted = fit_preprocessor(skewed, spec)
    stream = streaming.stream_preprocess(streaming.read_stream(spark, folder, skewed.schema), fitted)
    out = str(tmp_path / "out")
    streaming.append_to(stream, out, str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(out).exceptAll(fitted.transform(skewed)).count() == 0


def test_chunks(spark, skewed, folder, tmp_path):
    seen = []
    stream = streaming.read_stream(spark, folder, skewed.schema, files_per_trigger=1)
    query = streaming.each_chunk(stream, lambda df, i: seen.append(df.count()), str(tmp_path / "progress"))
    query.awaitTermination()
    assert len(seen) == 3 and sum(seen) == 3000


def test_row_windows_are_refused(spark, skewed, folder):
    stream = streaming.read_stream(spark, folder, skewed.schema)
    with pytest.raises(DataError) as error:
        build_series_features(stream, SeriesFeatures("t", lag_features={"l": ("v", 1)}))
    assert error.value.code == "ts_streaming_unsupported"
    calendar = build_series_features(stream, SeriesFeatures("t", expand_datetime=True))
    assert calendar.isStreaming and "t__year" in calendar.columns
