"""The whole-run query joins the order tables once."""

import pytest

from catalog import fits
from catalog.fixture import featured


class Reached(Exception):
    pass


def test_training_segmentation_and_counts_share_one_join(spark, sf_dir, monkeypatch):
    seen = []

    def note(rows):
        seen.append(rows)
        raise Reached

    monkeypatch.setattr(fits, "train_and_evaluate", note)
    with pytest.raises(Reached):
        fits.run_report(spark, sf_dir)
    rows, own = seen[0], featured(spark, sf_dir)
    assert not [f for f in rows.inputFiles() if f.removeprefix("file:").lstrip("/").startswith(sf_dir.lstrip("/"))]
    assert rows.schema.names == own.schema.names and rows.dtypes == own.dtypes
    assert rows.exceptAll(own).isEmpty() and own.exceptAll(rows).isEmpty()
