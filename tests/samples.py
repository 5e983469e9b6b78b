"""Sample rows and folders that several test files use."""

from riverwatch import schema as S

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

# Six readings that reach every risk level and both sides of the alert rule.
GOLDEN = [
    ("2024-01-01T00:00:00", "LOC001", 88.0, 1.1, 17.5, 2.4),
    ("2024-01-01T01:00:00", "LOC001", 88.0, 4.2, 16.9, 3.1),
    ("2024-01-01T02:00:00", "LOC001", 88.0, 5.6, 15.2, 4.6),
    ("2024-01-01T03:00:00", "LOC002", 31.5, 0.4, 12.8, 1.9),
    ("2024-01-01T04:00:00", "LOC002", 31.5, 9.3, 11.4, 6.2),
    ("2024-01-01T05:00:00", "LOC001", 88.0, 3.4, 14.0, 2.9),
]


def readings_with(spark, rows):
    """rows of (rain, river) -> full readings with one location."""
    data = [(f"2024-01-01T0{i % 10}:00:00", "X", 0.0, r, 20.0, v) for i, (r, v) in enumerate(rows)]
    return spark.createDataFrame(data, S.READING)
