"""Helpers of the tests of the training-data operators."""

import os

import pytest

from quirespark.llm.encoding import TOKENIZERS, VOCABULARY

RANKS = os.path.join(TOKENIZERS, VOCABULARY)
needs_vocabulary = pytest.mark.skipif(not os.path.exists(RANKS), reason="no vocabulary file")


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)
