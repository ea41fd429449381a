"""Checkpoint folders: taken from the session."""

from shelfwise.session import SESSION_DEFAULTS, ensure_checkpoint_dir


def test_checkpoint_dir_is_read_from_the_session(spark):
    current = spark.sparkContext.getCheckpointDir()
    assert ensure_checkpoint_dir(spark) == current  # an existing setting is never replaced


def test_broadcasts_are_decided_on_measured_sizes():
    assert SESSION_DEFAULTS["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert SESSION_DEFAULTS["spark.sql.adaptive.enabled"] == "true"
    assert "spark.sql.adaptive.autoBroadcastJoinThreshold" in SESSION_DEFAULTS
