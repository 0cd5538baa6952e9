from __future__ import annotations

from scorewright import two_card
from scorewright.operators.score import score_append, source_projection
from scorewright.sources.features import indicators
from scorewright.streaming.score_stream import score_stream


def test_stream_scores_like_batch(spark, tmp_path):
    card = two_card()
    feats = source_projection(indicators(spark, "/root/testdata/sf0.001"), card)
    src = str(tmp_path / "landing")
    feats.where("scorecard = 1 OR scorecard IS NULL").write.parquet(src + "/part=1")
    q = score_stream(spark, src, str(tmp_path / "scored"), card, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(300)
    feats.where("scorecard = 0 OR scorecard = 2").write.parquet(src + "/part=2")
    q = score_stream(spark, src, str(tmp_path / "scored"), card, checkpoint=str(tmp_path / "ck"))
    q.awaitTermination(300)
    streamed = spark.read.parquet(str(tmp_path / "scored"))
    batch = score_append(feats, card)
    cols = ["infocheck_id", "informconf_id", "score_pos", "flow_pos"]
    assert streamed.count() == batch.count()
    assert streamed.select(*cols).exceptAll(batch.select(*cols)).count() == 0
