"""Rows that every corpus operator must cope with."""


def doc(doc_id, text, lang="en"):
    return doc_id, text, lang, "src", None if text is None else len(text)


#: Nulls in any column, empty and blank texts, repeated rows, a very long text,
#: other scripts.
MESSY = [
    doc(1, "The quick brown fox jumps over the lazy dog and runs away from it"),
    doc(1, "The quick brown fox jumps over the lazy dog and runs away from it"),
    doc(2, None), doc(3, ""), doc(4, " \n\t "), doc(None, "no id here"), doc(None, None, None),
    (5, "only text", None, None, None),
    doc(6, "word " * 60_000),
    doc(7, "данные и 数据 بيانات"), doc(8, "!!! 12 ??"),
]
