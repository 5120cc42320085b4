"""Sample landing documents and table folders that several test modules use."""

from __future__ import annotations

import json
import os

SMALL_SF = "/root/testdata/sf0.001"

# ---------------------------------------------------------------------------
# Hand-written landing documents (pretty-printed, one per file).
# ---------------------------------------------------------------------------

SEASON_2020 = {
    "temporada": 2020,
    "data": [
        {"fecha": "08-08-2020", "local": "Alpha", "visitante": "Beta", "marcador": "2 - 1", "url": "m/2020/1"},
        {"fecha": "Sunday, August 9, 2020", "local": "Gamma", "visitante": "Delta", "marcador": "1 - 3",
         "url": "m/2020/2"},
        {"fecha": "not a date", "local": "Alpha", "visitante": "Gamma", "marcador": "0 - 0", "url": "m/2020/3"},
        {"fecha": "15-08-2020", "local": "Beta", "visitante": "Delta", "marcador": "Sin jugar", "url": "m/2020/4"},
    ],
}

# Two exact ties: Alpha/Gamma (3 pts, +1, 1 goal) and Beta/Delta (0 pts, -1, 0 goals).
SEASON_2021 = {
    "temporada": 2021,
    "data": [
        {
            "fecha": "Friday, April 2, 2021", "local": "Alpha", "visitante": "Beta", "marcador": "1 - 0",
            "url": "m/2021/1",
            "Tiros totales_local": 12, "Tiros totales_visitante": 7,
            "Disparos a puerta_local": 5, "Disparos a puerta_visitante": 2,
            "Faltas_local": 10, "Faltas_visitante": 14,
            "Tarjetas amarillas_local": 1, "Tarjetas amarillas_visitante": 3,
            "Tarjetas rojas_local": 0, "Tarjetas rojas_visitante": 1,
            "Saques de esquina_local": 6, "Saques de esquina_visitante": 2,
            "Pases precisos_local": "271 (83%)", "Pases precisos_visitante": "198 (66%)",
            "Posesión_local": "55%", "Posesión_visitante": "45%",
        },
        {
            "fecha": "03-04-2021", "local": "Gamma", "visitante": "Delta", "marcador": "1 - 0",
            "url": "m/2021/2",
            "Tiros totales_local": 9, "Tiros totales_visitante": 11,
        },
    ],
}

SEASON_2026 = {
    "temporada": 2026,
    "data": [
        {
            "fecha": "Friday, May 8", "local": "Delta", "visitante": "Alpha", "marcador": "0 - 2",
            "url": "m/2026/1",
            "Total shots_local": 15, "Total shots_visitante": 8,
            "Shots on target_local": 4, "Shots on target_visitante": 6,
            "Fouls committed_local": 11, "Fouls committed_visitante": 9,
            "Yellow cards_local": 2, "Yellow cards_visitante": 0,
            "Red cards_local": 0, "Red cards_visitante": 0,
            "Corners_local": 3, "Corners_visitante": 5,
            "Accurate passes_local": "120 (62.5%)", "Accurate passes_visitante": 12,
            "Posesión_local": "61.5%", "Posesión_visitante": "38.5%",
        },
        {
            "fecha": "Saturday, May 9", "local": "Beta", "visitante": "Gamma", "marcador": "2 - 1 (4-3)",
            "url": "m/2026/2",
        },
    ],
}

# A later drop: a field no earlier file had, and a statistic that was a
# plain number before and now comes as "n (p%)".
SEASON_2026_LATE = {
    "temporada": 2026,
    "data": [
        {
            "fecha": "Friday, May 15", "local": "Gamma", "visitante": "Alpha", "marcador": "3 - 3",
            "url": "m/2026/3",
            "Accurate passes_visitante": "77 (58%)",
            "Expected goals_local": "1.7",
        },
    ],
}

EMPTY_SEASON = {"temporada": 2022, "data": []}


def write_doc(folder: str, name: str, doc: dict) -> str:
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(doc, f, indent=2, ensure_ascii=False)
    return path
