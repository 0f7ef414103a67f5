"""Compare a Spark result with an oracle's, as bags of rows."""


def bag(table) -> list[tuple[str, ...]]:
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    text = lambda v: repr(round(v, 6) + 0.0) if isinstance(v, float) else repr(v)
    return sorted(tuple(map(text, row)) for row in zip(*columns, strict=True))


def assert_same(df, con, sql: str) -> None:
    ours, theirs = df.toArrow(), con.execute(sql).to_arrow_table()
    assert sorted(ours.column_names) == sorted(theirs.column_names)
    assert bag(ours) == bag(theirs)
