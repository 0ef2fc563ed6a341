"""Layouts of JSON files whose first lines do not show them."""

from logloom.sources.logs import read_log_entries


def test_blank_lines_ahead_and_objects_opened_by_a_key(spark, tmp_path):
    files = {
        "blank.json": "\n" * 5 + '[\n{"a":1},\n{"a":2}\n]\n',
        "far.json": "\n" * 300 + '{\n"a":3\n}\n',
        "key.json": '{"a":\n{"b":\n4}\n}\n',
        "word.json": '{"a": 5, "b"\n: [6\n]}\n',
        "broken.json": '{"a":\n{"a":7}\n{"a":8}\n',
        "bad.json": '{bad\n{"a":9}\n',
        "empty.json": "\n\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    found = {}
    for r in read_log_entries(spark, str(tmp_path)).collect():
        found.setdefault(r.source_file, []).append(r.raw_content.translate({ord(c): None for c in " \n"}))
    assert {k: sorted(v) for k, v in found.items()} == {
        "blank.json": ['{"a":1}', '{"a":2}'], "far.json": ['{"a":3}'], "key.json": ['{"a":{"b":4}}'],
        "word.json": ['{"a":5,"b":[6]}'], "broken.json": ['{"a":7}', '{"a":8}'], "bad.json": ['{"a":9}'],
    }
