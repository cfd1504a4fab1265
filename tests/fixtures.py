"""Small inputs with known results.

Fixed values: rows that published results belong to.
"""

MULTI_GROUP = [
    ("A", 5, 3), ("B", 6, 1), ("A", 7, 4), ("B", 1, 1), ("A", 2, 2), ("B", 3, 1), ("A", 4, 2),
    ("B", 5, 3), ("A", 6, 1), ("B", 7, 4), ("A", 1, 1), ("B", 2, 2), ("A", 3, 1), ("B", 4, 2),
]
BASKETS = [
    ("A", [1, 2, 1, 7, 10, 4]), ("B", [9, 3, 6, 7, 8, 14]), ("C", [1, 12, 9, 2, 11, 14]),
    ("D", [2, 3, 4, 5, 13, 12]), ("C", [1, 12, 9, 2, 11, 14]), ("C", [1, 2, 7, 5, 8, 11]),
]
SALTED = [
    ("A", 1), ("A", 2), ("A", 3), ("A", 4), ("A", 5), ("B", 6), ("B", 7), ("B", 8), ("B", 9), ("B", 9),
]
NESTED = [
    ("A", 5, 3, [(0.1, 0.2), (1.1, 1.2)]),
    ("B", 5, 3, [(1.0, 2.0), (1.0, 2.0)]),
    ("C", 5, 3, [(1.0, 2.0), (1.0, 2.0)]),
]
LEAD_LAG = [
    ("A", 1, 100), ("A", 2, 101), ("A", 3, 102), ("A", 4, 103), ("A", 5, 104), ("A", 6, 105), ("A", 7, 103),
    ("A", 8, 102), ("A", 9, 105), ("A", 11, 100), ("A", 12, 101), ("A", 13, 102), ("A", 14, 103), ("A", 15, 104),
    ("A", 16, 105), ("A", 17, 103), ("A", 18, 102), ("A", 19, 105), ("B", 1, 100), ("B", 2, 101), ("B", 3, 102),
    ("B", 4, 103), ("B", 5, 104), ("B", 6, 105), ("B", 7, 103), ("B", 8, 102), ("B", 9, 105), ("B", 11, 106),
    ("B", 12, 101), ("B", 13, 102), ("B", 14, 103), ("B", 15, 104), ("B", 16, 103), ("B", 17, 103), ("B", 18, 102),
    ("B", 19, 105),
]
INFLECTIONS = {("A", 17), ("B", 15)}
SESSION_TIMES = [
    ("A", 1), ("A", 2), ("A", 3), ("A", 4), ("A", 15), ("A", 16), ("A", 17), ("A", 28), ("A", 29), ("A", 30),
    ("A", 41), ("A", 42), ("A", 53), ("A", 54), ("A", 55), ("A", 56), ("B", 12), ("B", 13), ("B", 14), ("B", 15),
    ("B", 16), ("B", 17), ("B", 18), ("B", 19), ("B", 22), ("B", 23), ("B", 34), ("B", 35), ("B", 36), ("B", 37),
    ("B", 48), ("B", 49),
]
EDGES = [
    (0, 14), (2, 18), (4, 17), (5, 15), (7, 13), (9, 15), (3, 17), (4, 19), (7, 18), (9, 16), (5, 14),
    (1, 13), (1, 12), (5, 14), (4, 18), (3, 17), (7, 15), (2, 13), (7, 15), (2, 17), (7, 19), (9, 18),
    (2, 16), (7, 14), (9, 13), (9, 12), (25, 14), (24, 18), (23, 17), (27, 15), (22, 13), (27, 15),
    (22, 17), (27, 19), (29, 18), (22, 16), (27, 14), (29, 13), (29, 24), (14, 23), (17, 26), (19, 28),
    (15, 25), (11, 27), (11, 29), (15, 27), (14, 24), (13, 27), (23, 7), (27, 5), (22, 3), (27, 5),
    (22, 7), (27, 9), (29, 8), (22, 6), (23, 3), (27, 4), (22, 5), (27, 7), (22, 9), (27, 4), (29, 6),
    (22, 9), (24, 38), (37, 38), (39, 37), (25, 35), (10, 35), (20, 21), (36, 21), (36, 20), (5, 29),
    (5, 22), (22, 29), (39, 31), (32, 31),
]
WEATHER = [
    ("overcast", 83, "hot", 86, "high", False, "yes"), ("overcast", 64, "cool", 65, "normal", True, "yes"),
    ("overcast", 72, "mild", 90, "high", True, "yes"), ("overcast", 81, "hot", 75, "normal", False, "yes"),
    ("rainy", 70, "mild", 96, "high", False, "yes"), ("rainy", 68, "cool", 80, "normal", False, "yes"),
    ("rainy", 65, "cool", 70, "normal", True, "no"), ("rainy", 75, "mild", 80, "normal", False, "yes"),
    ("rainy", 71, "mild", 91, "high", True, "no"), ("sunny", 85, "hot", 85, "high", False, "no"),
    ("sunny", 80, "hot", 90, "high", True, "no"), ("sunny", 72, "mild", 95, "high", False, "no"),
    ("sunny", 69, "cool", 70, "normal", False, "yes"), ("sunny", 75, "mild", 70, "normal", True, "yes"),
]
