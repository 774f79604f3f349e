import datetime as dt
import random

from broadsheet.operators.cleaning import with_dates

CASES = [
    *[(t, None) for t in (None, "", "  ", "nan", "N/A", "n/a", "null", "None", "NONE")],
    ("2022-02-17", "2022-02-17"),
    ("2021-09-11T00:00:00Z", "2021-09-11"),
    ("2021-09-11T23:59:59Z", "2021-09-11"),
    ("02/23/2023", "2023-02-23"),
    ("12/28/2021", "2021-12-28"),
    ("10/14/2023", "2023-10-14"),
    ("23/08/2023", "2023-08-23"),
    ("23-08-2023", "2023-08-23"),
    ("31-01-2022", "2022-01-31"),
    ("13-06-2020", "2020-06-13"),
    ("05-06-2020", "2020-06-05"),
    ("12/06/2020", "2020-12-06"),
    ("21 Feb 2020", "2020-02-21"),
    ("02 Jan 2021", "2021-01-02"),
    ("2 january 2021", "2021-01-02"),
    ("21  feb\t2020", "2020-02-21"),
    (" 2022-2-7\n", "2022-02-07"),
    ("October 19, 2022", "2022-10-19"),
    ("Oct 19, 2022", "2022-10-19"),
    ("Jan 01, 2020", "2020-01-01"),
    ("may 5, 2020", "2020-05-05"),
    ("29 Feb 2020", "2020-02-29"),
    *[
        (t, None)
        for t in (
            "not-a-date", "hello world", "99/99/9999", "32-13-2020", "2020-13-01", "abc", "!!??", "99999",
            "29 Feb 2021", "2021-02-29", "30/02/2020", "20220217", "2022-02-17 extra", "Oct 19 2022",
            "2021-09-11T00:00:00", "31-04-2020", "22-02-17",
        )
    ],
]


def test_cases(spark):
    rows = [(i, t) for i, (t, _) in enumerate(CASES)]
    wrong = []
    for r in with_dates(spark.createDataFrame(rows, "i int, published_date string")).collect():
        text, want = CASES[r.i]
        if want is None:
            fine = (r.pub_year, r.pub_quarter, r.pub_month) == (None, None, None)
            fine = fine and r.published_date == (text or "")
        else:
            day = dt.date.fromisoformat(want)
            fine = r.published_date == want
            fine = fine and (r.pub_year, r.pub_quarter, r.pub_month) == (day.year, (day.month - 1) // 3 + 1, day.month)
        if not fine:
            wrong.append((text, want, r))
    assert not wrong


def test_written_dates_come_back(spark):
    rng = random.Random(3)
    formats = ["%Y-%m-%d", "%Y-%m-%dT%H:%M:%SZ", "%m/%d/%Y", "%d-%m-%Y", "%d %b %Y", "%d %B %Y", "%B %d, %Y", "%b %d, %Y"]
    rows, want = [], {}
    for i in range(500):
        day = dt.datetime(1950, 1, 1) + dt.timedelta(days=rng.randint(0, 40000))
        rows.append((i, day.strftime(rng.choice(formats))))
        want[i] = day.strftime("%Y-%m-%d")
    got = with_dates(spark.createDataFrame(rows, "i int, published_date string")).collect()
    assert not [(rows[r.i], r.published_date) for r in got if r.published_date != want[r.i]]
