"""Secrets in layers that repeat."""

import base64

import pytest

from capturemill.llm import secrets


def _b64(t):
    return base64.b64encode(t.encode()).decode()


@pytest.mark.parametrize("depth", [1, 2, 3, 4])
def test_each_copy_of_a_wrapped_secret_is_found(depth):
    run = "password=hunter22"
    for _ in range(depth):
        run = _b64(run)
    text = f"{run}\nplain words\n{run}\n{_b64('see ' + run)}"
    places = [0, text.index(run, 1), text.rindex("\n") + 1]
    spans = secrets.all_spans(text)
    for at, end in zip(places, [*places[1:], len(text)], strict=True):
        assert any(at <= a < b <= end for a, _, b in spans)
    assert secrets.redact(text).count("[secret]") >= 3 and run not in secrets.redact(text)


def test_deep_layers_end():
    text = "x password%" + "25" * 1500 + "3Dhunter22"
    assert (2, 0, len(text)) in secrets.all_spans(text)
