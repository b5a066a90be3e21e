"""Documents for the tests of the training-data operators."""

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    """Frames of any rows that also have columns of the operators' own names."""
    def build(rows, schema="doc_id bigint, text string"):
        frame = spark.createDataFrame(rows, schema)
        return frame.withColumns({"_out": frame[frame.columns[0]], "t": frame[frame.columns[0]],
                                  "kept": frame[frame.columns[0]]})

    return build
