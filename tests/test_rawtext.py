"""The texts of JSON array elements as they were written."""

import json

from hypothesis import given, settings
from hypothesis import strategies as st

from starload.sources.rawtext import array_texts

VALUES = st.recursive(st.none() | st.booleans() | st.integers() | st.floats(allow_nan=False, allow_infinity=False) | st.text(),
                      lambda inner: st.lists(inner) | st.dictionaries(st.text(), inner), max_leaves=12)


@settings(max_examples=200, deadline=None)
@given(st.lists(VALUES), st.dictionaries(st.text(), VALUES), st.sampled_from([None, 1, "\t"]), st.booleans())
def test_elements_are_the_text_between_the_commas(items, others, indent, ascii_):
    doc = {**{k: v for k, v in others.items() if k != "a"}, "a": {"b": items}}
    text = json.dumps(doc, indent=indent, ensure_ascii=ascii_)
    got = array_texts(text, ("a", "b"))
    assert [json.loads(t) for t in got] == items
    at = 0
    for t in got:  # each is a stretch of the document, one after the other, without blanks around it
        at = text.index(t, at) + len(t)
        assert t == t.strip(" \t\r\n") or t[0] == '"'


def test_what_is_no_array_has_no_elements():
    assert array_texts('{"a": 1}', ("a",)) is None and array_texts('{"a": {}}', ("a", "b")) is None
    assert array_texts("[1 , 2.50]", ()) == ["1", "2.50"] and array_texts('{"a":[]}', ("a",)) == []
    assert array_texts("7", ("a",)) is None and array_texts('{"a":"]"}', ("a",)) is None
