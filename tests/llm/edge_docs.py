"""Small documents with every awkward case."""

# Extra columns whose names the operators use themselves.
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "size long, kept string, fp string, root string, copies string, spans string, tokens string, path string")

PLAIN = " ".join(f"word{i % 53} and more{i % 47}," for i in range(60))


def edge_rows():
    other = " ".join(f"another{i % 41} text{i % 37} here." for i in range(70))
    texts = [
        (1, None, "a"), (2, "", "a"), (3, " \n\t \n", None), (None, PLAIN + "\nnameless", "b"), (None, None, None),
        (4, PLAIN, "a"), (4, PLAIN, "a"), (5, PLAIN, "b"), (6, PLAIN + " x", "c"), (7, other, "c"),
        (8, "Very long.\n" + " ".join(f"w{i * i % 10007}" for i in range(30000)), "d"),
        (9, "mail me.x@host.example.org or +1 (555) 010-1234 from 10.0.0.255, 999.1.1.1 card 4111 1111 1111 1111 ok", "a"),
        (10, "line one\nline one\nline one\n\n\n" + "the same words again " * 40, "b"),
        (11, "%%% ### " * 60, "c"), (12, "Ünïcödé ßtraße ﬁne 中文 текст \U0001F600 " * 12, "é"),
    ]
    return [(i, t, "en", s, None if t is None else len(t), 7, "k", "f", "r", "c", "s", "t", "p") for i, t, s in texts]
