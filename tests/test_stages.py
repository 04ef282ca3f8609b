"""The ml stages: fit, save, load, use in a Pipeline."""

import json

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from plateau.operators import ranker as RK
from plateau.operators import text as TX
from plateau.operators.stages import CatalogEncoder, CatalogEncoderModel, LambdaRanker, LambdaRankerModel
from tests.test_boosting import learnable
from tests.test_text_encoder import ROWS, SCHEMA


def test_ranker_stage_in_a_pipeline(spark, tmp_path):
    df = learnable(spark, 30, 15).withColumn("held", F.col("user_id") >= "u20")
    stage = LambdaRanker(featureCols=["a", "b"], validationCol="held", num_leaves=6, min_child_samples=5, learning_rate=0.3,
                         max_boost_rounds=4, early_stopping_rounds=2, ndcg_eval_at=[5, 10])
    model = Pipeline(stages=[stage]).fit(df)
    out = model.transform(df).select("user_id", "recipe_id", "score")
    rows = sorted(map(tuple, out.collect()))
    plain = RK.fit_ranker(df.filter("NOT held"), df.filter("held"), ["a", "b"], stage.params_of())
    assert rows == sorted(map(tuple, RK.score_frame(df, plain.scorer).select("user_id", "recipe_id", "score").collect()))
    assert model.stages[0].feature_importances == plain.importance and len({r[2] for r in rows}) > 3
    model.write().overwrite().save(str(tmp_path / "m"))
    back = PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(back.stages[0], LambdaRankerModel)
    assert sorted(map(tuple, back.transform(df).select("user_id", "recipe_id", "score").collect())) == rows
    assert back.stages[0].feature_importances == plain.importance and back.stages[0].result.best_round == plain.best_round
    assert back.stages[0].getOrDefault("predictionCol") == "score"
    stage.write().overwrite().save(str(tmp_path / "e"))
    again = LambdaRanker.load(str(tmp_path / "e"))
    assert again.params_of() == stage.params_of() and again.getOrDefault("featureCols") == ["a", "b"]


def test_features_are_chosen_when_not_named(spark):
    df = learnable(spark, 12, 12).withColumn("text", F.lit("x"))
    model = LambdaRanker(num_leaves=4, min_child_samples=5, max_boost_rounds=2).fit(df)
    assert model.result.scorer.features == ["a", "b"] and len(model.result.scorer.trees) == 2


def test_encoder_stage(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA).withColumn("train", F.col("recipe_id") != "4")
    specs = [["author_id", "freq", "author_id_freq", 0], ["tags", "top_k", "tag__", 5], ["description", "tfidf", "d_", 50]]
    model = CatalogEncoder(encoders=json.dumps(specs), trainCol="train").fit(df)
    want = TX.TextEncoder(tuple(TX.Encoder(*s) for s in specs)).fit(df.filter("train").select("recipe_id"), df).transform(df)
    rows = sorted(map(tuple, want.collect()))
    got = model.transform(df)
    assert got.columns == want.columns and sorted(map(tuple, got.collect())) == rows
    model.write().overwrite().save(str(tmp_path / "c"))
    back = CatalogEncoderModel.load(str(tmp_path / "c")).transform(df)
    assert back.columns == want.columns and sorted(map(tuple, back.collect())) == rows
