"""Odd rows the tests of this folder share."""

DATA = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000 + "end."

# id, text: nulls, empty and very long texts, ties, repeated rows, a null id.
ODD = [
    (1, None), (2, ""), (3, " \n "), (4, LONG), (5, LONG), (6, "One line.\nTwo lines.\nThree lines.\nFour."),
    (6, "One line.\nTwo lines.\nThree lines.\nFour."), (7, "One line.\nTwo lines.\nThree lines.\nFour."),
    (None, "no id here"), (None, "no id here"), (8, "12345 !!! ???"), (9, "Ünïcödé \U0001F600 text"),
    (10, "a\x00b\tc\r\nd"),
]
CLASHING = [
    "row", "text_key", "word", "words", "found", "start", "fingerprint", "component_id", "pack", "n", "gone_id",
    "found_id", "found_key", "hit_id", "hit_key", "root", "key", "ids", "pairs", "decoded", "row_no",
]
