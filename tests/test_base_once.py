"""The registered training and scoring read orders and lineitem once (M8)."""

from seriesforge.plans import catalog as C
from seriesforge.plans import train as TR


def test_scoring_reads_the_tables_once(spark, tmp_path, monkeypatch):
    """The competition and the production features share one stored base panel."""
    sf = "/root/testdata/sf0.001"
    made, seen = [], []
    plain = C.T.base_panel

    def counted(*args, **kw):
        made.append(args)
        return plain(*args, **kw)

    def competition(features, spec, cfg):
        seen.append(features)
        raise InterruptedError

    def winners(spark_, sf_dir, base=None):
        try:
            return C_trained(spark_, sf_dir, base)
        except InterruptedError:
            return {"winners": spark.createDataFrame([(1, 1.0, "run")], "horizon int, rmse double, run_path string")}

    C_trained = C.trained
    monkeypatch.setattr(C.T, "base_panel", counted)
    monkeypatch.setattr(TR, "train_competition", competition)
    monkeypatch.setattr(C, "trained", winners)
    monkeypatch.setattr(C, "checkpoint_dir", lambda s: str(tmp_path), raising=False)
    monkeypatch.setattr("seriesforge.session.checkpoint_dir", lambda s: str(tmp_path))
    monkeypatch.setattr(TR, "update_registry", lambda *a: None)
    monkeypatch.setattr(TR, "read_registry", lambda *a: None)
    monkeypatch.setattr(TR, "score_production", lambda features, spec, registry: seen.append(features) or features)
    C.QUERIES["m8_score_with_models"](spark, sf)
    assert len(seen) == 2 and len(made) == 1
    for features in seen:
        assert not features.inputFiles()  # what is read is the checkpoint
    assert seen[1].count() == plain(spark, sf, exact=True).count()
