"""Small raw files of every source, written by the tests."""

from __future__ import annotations

import json
import os

BOM = "﻿"
SALES_HEADER = (
    "Date mutation,Nature mutation,Valeur fonciere,No voie,B/T/Q,Type de voie,Voie,Code postal,Code departement,"
    "Code commune,Prefixe de section,Section,No plan,Reference document,Identifiant de document,Type local,"
    "Surface reelle bati,Nombre pieces principales"
)


def sale(date, value, number, kind="Appartement", surface="50", street="RIVOLI", postal="75001", suffix="", plan="12", nature="Vente", rooms="2", commune="101"):
    return f'{date},{nature},"{value}",{number},{suffix},RUE,{street},{postal},75,{commune},,AB,{plan},,,{kind},{surface},{rooms}'


def write(path, *lines):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as handle:
        handle.write("\n".join(lines) + "\n")
    return path


def box(x, y, size=1.0):
    return [[[x, y], [x + size, y], [x + size, y + size], [x, y + size], [x, y]]]


def feature(properties, kind, coordinates):
    return {"type": "Feature", "properties": properties, "geometry": {"type": kind, "coordinates": coordinates}}


def collection(path, features):
    return write(path, json.dumps({"type": "FeatureCollection", "features": features}, indent=1))


def all_inputs(root):
    """Two districts side by side in degrees: district 1 at x 2..3, district 2 at x 3..4."""
    sales = f"{root}/dvf"
    write(
        f"{sales}/valeursfoncieres-2024-paris.csv",
        SALES_HEADER,
        sale("02/01/2024", "500000,00", "1"),
        sale("02/01/2024", "500000,00", "1"),
        sale("03/01/2024", "400 000", "7", suffix="B"),
        sale("04/01/2024", "300000", "99", plan="77"),
        sale("04/01/2024", "300000", "98", plan="78"),
        sale("05/01/2024", "600000", "2", kind="Maison", postal="75002", commune="102", street="PAIX", surface="100"),
        sale("05/01/2024", "600000", "2", nature="Echange"),
        sale("05/01/2024", "600000", "2", surface="10"),
    )
    header = SALES_HEADER.split(",")
    shuffled = [*reversed(header), "Unused"]
    row = dict(zip(header, "06/02/2025,Vente,700000,1,,RUE,RIVOLI,75001,75,101,,AB,12,,,Appartement,70,3".split(",")))
    write(
        f"{sales}/valeursfoncieres-2025-paris.csv",
        ",".join(shuffled),
        ",".join([*(row[name] for name in reversed(header)), "x"]),
    )
    write(f"{sales}/valeursfoncieres-old-paris.csv", "no,year", "1,2")
    addresses = write(
        f"{root}/adresses.csv",
        BOM + "cle_interop;commune_insee;voie_nom;numero;suffixe;long;lat;certification_commune;other",
        "75101_1;75101;Rue de Rivoli;1;;2.5;48.5;1;x",
        "75101_R1;75101;Rue Rivoli;1;;2.25;48.5;1;x",
        "75101_R7;75101;Rue Rivoli;7;;2.75;48.25;0;x",
        "75102_P2;75102;Rue Paix;2;;3.5;48.5;1;x",
        "75101_L;75101;Rue Autre;5;;2.5;48.75;1;x",
        "92000_X;92000;Rue Rivoli;1;;9.5;48.5;1;x",
        "75101_N;75101;Rue Rivoli;3;;;48.5;1;x",
    )
    links = write(
        f"{root}/links.csv",
        "idu,id_adr,type_lien,nb_adr,nb_parc",
        "75101000AB0077,75101_L,BAN,1,1",
        "75101000AB0078,,,,",
    )
    districts = collection(
        f"{root}/districts.geojson",
        [
            feature({"c_ar": 2, "c_arinsee": 75102, "l_aroff": "Bourse", "l_ar": "2eme", "surface": 991.126, "perimetre": 4.0}, "MultiPolygon", [box(3.0, 48.0)]),
            feature({"c_ar": 1, "c_arinsee": 75101, "l_aroff": "Louvre", "l_ar": "1er", "surface": 1824.615, "perimetre": 6054.68}, "Polygon", box(2.0, 48.0)),
        ],
    )
    quartiers = collection(
        f"{root}/quartiers.geojson",
        [
            feature({"c_quinsee": 7510201, "c_qu": 5, "c_ar": 2, "l_qu": "Gaillon", "surface": 1.0, "perimetre": 2.0}, "Polygon", box(3.0, 48.0)),
            feature({"c_quinsee": 7510101, "c_qu": 1, "c_ar": 1, "l_qu": "Halles", "surface": 1.0, "perimetre": 2.0}, "Polygon", box(2.0, 48.0)),
        ],
    )
    streets = collection(
        f"{root}/streets.geojson",
        [
            feature({"c_desi": "RUE", "c_liaison": "", "l_voie": "RIVOLI", "n_sq_vo": "s1", "l_longmin": "rue de Rivoli"}, "LineString", [[2.5, 48.5], [3.5, 48.5]]),
            feature({"c_desi": "RUE", "c_liaison": None, "l_voie": "PAIX", "objectid": 7}, "MultiLineString", [[[3.25, 48.25], [3.5, 48.25]], [[3.75, 48.75], [4.5, 48.75]]]),
            feature({"c_desi": " ", "l_voie": None, "objectid": 8}, "LineString", [[2.5, 48.5], [2.6, 48.5]]),
            feature({"c_desi": "RUE", "l_voie": "VIDE", "objectid": 9}, "LineString", []),
        ],
    )
    iris = write(
        f"{root}/iris.csv",
        "DEP;CODE_IRIS;NOM_IRIS;TYP_IRIS;INSEE_COM;Geo Shape",
        '75;751010101;Un;H;75101;"' + json.dumps({"type": "Polygon", "coordinates": box(2.0, 48.0, 0.5)}).replace('"', '""') + '"',
        '92;920010101;Non;H;92001;"' + json.dumps({"type": "Polygon", "coordinates": box(2.0, 48.0)}).replace('"', '""') + '"',
    )
    income = write(
        f"{root}/income.csv",
        BOM + "IRIS;DEC_MED21;DEC_TP6021;DEC_Q121;DEC_Q321;DEC_PIMP21",
        "751010101;30000;10,5;20000;40000;60",
        "751010102;32000;ns;22000;44000;70",
        "751020101;28000;12;18000;38000;",
        "920010101;1;1;1;1;1",
    )
    rents = write(
        f"{root}/rents.csv",
        BOM + "Année;Loyers de référence;Loyers de référence majorés;Loyers de référence minorés;Numéro INSEE du quartier;x",
        "2024;25,5;30,6;17,9;7510101;a",
        "2025;26;31,2;18,2;7510101;a",
        "2025;28;33,6;19,6;7510102;a",
        "n;1;1;1;7510101;a",
    )
    social = write(
        f"{root}/social.csv",
        BOM + "Arrondissement;Année du financement - agrément;Nombre total de logements financés;Dont nombre de logements PLA I;"
        "Dont nombre de logements PLUS;Dont nombre de logements PLS;Identifiant livraison",
        "1;2019;100;1;1;1;old",
        "1;2020;10;5;3;2;a",
        "1;2024;20;10;5;;b",
        "1;2024;4;1;1;2;b",
        "21;2024;9;9;9;9;c",
        "2;;9;9;9;9;c",
    )
    return {
        "sales": f"{sales}/valeursfoncieres-*-paris.csv",
        "addresses": addresses,
        "links": links,
        "districts": districts,
        "quartiers": quartiers,
        "streets": streets,
        "iris": iris,
        "income": income,
        "rents": rents,
        "social": social,
    }
