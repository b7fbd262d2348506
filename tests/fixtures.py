"""Small hand-checked inputs."""

import datetime as dt

from pyspark.sql import Row

# The ten-claim portfolio behind the documented worked example: only the columns that matter.
CLAIMS = [
    ("C18-1", "2018-09-15", "Water Damage", "Open", "Water intrusion in several rooms."),
    ("C18-2", "2018-09-15", "Wind", "Closed", "Wind damage to siding."),
    ("C18-3", "2018-09-15", "Water Damage", "Open", "Signs of mold; customer consults attorney."),
    ("C18-4", "2018-09-16", "Water Damage", "Closed", "Water seepage and moisture."),
    ("C18-5", "2018-09-15", "Water Damage", "Open", "Found black mold. Attorney representation."),
    ("C19-1", "2019-06-10", "Fire", "Closed", "Fire in kitchen."),
    ("C19-2", "2019-08-20", "Theft", "Closed", "Break-in, police report filed."),
    ("C20-1", "2020-03-15", "Water Damage", "Open", "Burst pipe, flooding, damp."),
    ("C20-2", "2020-06-01", "Liability", "Open", "Visitor injured. Lawsuit filed."),
    ("C21-1", "2021-09-01", "Wind", "Open", "Structural assessment needed."),
]
PAYMENTS = [
    ("C18-1", "2018-10-15", 15000, 50000), ("C18-1", "2018-12-01", 20000, 35000),
    ("C18-1", "2019-06-15", 10000, 25000), ("C18-2", "2018-10-20", 25000, 15000),
    ("C18-2", "2019-01-15", 15000, 0), ("C18-3", "2018-11-01", 10000, 100000),
    ("C18-3", "2019-03-01", 15000, 125000), ("C18-3", "2020-01-15", 30000, 150000),
    ("C18-3", "2021-06-01", 25000, 175000), ("C18-4", "2018-11-15", 18000, 12000),
    ("C18-4", "2019-02-01", 12000, 0), ("C18-5", "2019-01-15", 20000, 200000),
    ("C18-5", "2020-03-01", 50000, 250000), ("C18-5", "2021-09-15", 35000, 200000),
    ("C19-1", "2019-07-01", 45000, 15000), ("C19-1", "2019-10-15", 15000, 0),
    ("C19-2", "2019-09-15", 8000, 0), ("C20-1", "2020-04-15", 12000, 25000),
    ("C20-2", "2020-08-01", 15000, 150000), ("C21-1", "2021-10-15", 25000, 75000),
]

# Cumulative pooled triangle of the sixty-claim portfolio.
POOLED = {
    2018: [450500, 603500, 647500, 672500, 677500],
    2019: [447000, 620000, 702000, 720000],
    2020: [325500, 402000, 476500],
    2021: [344500, 455000, 463000],
    2022: [426000, 477000],
    2023: [162500],
}


def day(text):
    return dt.date.fromisoformat(text)


def claims(spark):
    rows = [
        Row(claim_id=c, loss_date=day(d), loss_type=t, claim_status=s, adjuster_notes=n,
            loss_description=None, state="FL", county="Miami-Dade", catastrophe_code=None)
        for c, d, t, s, n in CLAIMS
    ]
    schema = (
        "claim_id string, loss_date date, loss_type string, claim_status string,"
        " adjuster_notes string, loss_description string, state string, county string,"
        " catastrophe_code string"
    )
    return spark.createDataFrame(rows, schema)


def payments(spark):
    rows = [
        (f"P{i}", c, day(d), float(a), float(r)) for i, (c, d, a, r) in enumerate(PAYMENTS)
    ]
    schema = (
        "payment_id string, claim_id string, payment_date date, payment_amount double,"
        " reserve_amount double"
    )
    return spark.createDataFrame(rows, schema)


def cells(spark, triangle, loss_type="ALL"):
    """Cells from ``{origin: [cumulative, ...]}``; None leaves a hole."""
    rows = []
    for origin, values in triangle.items():
        before = 0.0
        for age, value in enumerate(values):
            if value is None:
                continue
            rows.append((loss_type, origin, age, float(value) - before, float(value), 1))
            before = float(value)
    schema = (
        "loss_type string, origin_period int, development_period int, incremental_value double,"
        " cumulative_value double, claim_count long"
    )
    return spark.createDataFrame(rows, schema)


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}
