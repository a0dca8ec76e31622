"""Inputs that the tests of the training-data operators share."""

SF = "/root/testdata/sf0.001"

#: Rows that every operator must take: null and empty texts, white space alone, a null id, equal rows, one long text.
ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a lost row of seven words or so"), (4, "same text here"),
       (4, "same text here"), (5, "same text here"), (6, "word " * 20_000), (7, "İÉK x y \u0001 <|endoftext|>")]
