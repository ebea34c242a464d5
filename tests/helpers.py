"""Brute-force counterparts for small fixtures."""

import contextlib
import io

import duckdb

from oracle.sql import query


def rows(frame, *columns):
    picked = frame.select(*columns) if columns else frame
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(frame):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        frame.explain("formatted")
    return text.getvalue()


def walked_codes(names):
    """Phonetic codes from the letter-by-letter SQL."""
    con = duckdb.connect()
    con.execute("CREATE TABLE given (name VARCHAR)")
    con.executemany("INSERT INTO given VALUES (?)", [[n] for n in names])
    sql = query("codes", "SELECT name, code FROM codes", "SELECT name FROM given")
    return dict(con.execute(sql).fetchall())


def edit_distance(left, right):
    return duckdb.execute("SELECT levenshtein(?, ?)", [left, right]).fetchone()[0]
