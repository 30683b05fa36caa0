import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

#: Extra columns named like those that operators use inside.
EXTRA = "spans string, kinds string, row string, w string, key long, n long, term string, cls string, root long, path string, of long, grp long"


@pytest.fixture
def documents(spark):
    """Builds a documents frame from (doc_id, text) pairs, with lang, source, n_chars and clashing extras."""

    def make(rows, lang="en"):
        langs = lang if isinstance(lang, list) else [lang] * len(rows)
        data = [(d, t, g, "s0", len(t or ""), *["x", "x", "x", "x", 1, 1, "x", "x", 1, "x", 1, 1]) for (d, t), g in zip(rows, langs, strict=True)]
        return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}")

    return make
