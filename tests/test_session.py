"""Scratch places."""


def test_scratch_location_keeps_any_scheme(spark, monkeypatch):
    import os

    from flightlens import session

    monkeypatch.setattr(session, "checkpoint_dir", lambda spark: "dbfs:/ckpt")
    place = session.scratch_location(spark, "store")
    assert place.startswith("dbfs:/ckpt/store-") and not os.path.exists("dbfs:")
