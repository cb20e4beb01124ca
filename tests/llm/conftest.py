"""The corpus tests need the public tokenizers; elsewhere they are left out."""

import pytest

pytest.importorskip("public_tokenizers")
