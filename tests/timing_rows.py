"""Raw lap rows shared by the timing and source tests."""

# (session, driver, lap, stint, compound, lap_us, pos, gap_us, ivl_us, pit_in_us, pit_out_us)
RAW = [
    (1, "AAA", 1.0, 1.0, "SOFT", 90_000_600, 1.0, None, None, 100_000_000, None),
    (1, "AAA", 2.0, 2.0, "HARD", None, 1.0, None, None, None, 123_400_500),
    (1, "AAA", 3.0, 2.0, "HARD", 90_000_600, 2.0, None, None, None, None),
    (1, "BBB", 1.0, 1.0, "SOFT", 91_000_000, 3.0, None, None, None, None),
    (1, "BBB", 2.0, 1.0, "SOFT", 91_000_000, 2.0, None, None, 200_000_000, 190_000_000),
    (1, "BBB", 3.0, 2.0, "MEDIUM", 91_000_000, 1.0, None, None, 300_000_000, None),
    (1, "ZZZ", 1.0, 1.0, "SOFT", 92_000_000, 2.0, 1_500_400, None, None, None),   # unknown code
    (1, "NUL", 1.0, 1.0, "SOFT", 50_000_000, 1.0, None, None, None, None),        # id 0: rejected
]
