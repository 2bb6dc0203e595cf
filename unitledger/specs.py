"""What a registry holds: datasets, tables, keys, renames and column types."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Unit type texts and the short technology names.
UNIT_TYPES = {
    "Windeinheit": "wind",
    "Solareinheit": "solar",
    "Biomasse": "biomass",
    "Wasser": "hydro",
    "Geothermie": "gsgk",
    "Verbrennung": "combustion",
    "Kernenergie": "nuclear",
    "Stromspeichereinheit": "storage",
    "Gasspeichereinheit": "gas_storage",
    "Gasverbrauchseinheit": "gas_consumer",
    "Stromverbrauchseinheit": "electricity_consumer",
    "Gaserzeugungseinheit": "gas_producer",
    "Stromerzeugungslokation": "location_elec_generation",
    "Stromverbrauchslokation": "location_elec_consumption",
    "Gaserzeugungslokation": "location_gas_generation",
    "Gasverbrauchslokation": "location_gas_consumption",
}
TYPE_OF_TECHNOLOGY = {v: k for k, v in UNIT_TYPES.items()}

# Technologies and the detail roles each one has.
TECHNOLOGY_ROLES = {
    "wind": ("extended", "eeg", "permit"),
    "solar": ("extended", "eeg", "permit"),
    "biomass": ("extended", "eeg", "kwk", "permit"),
    "hydro": ("extended", "eeg", "permit"),
    "gsgk": ("extended", "eeg", "kwk", "permit"),
    "combustion": ("extended", "kwk", "permit"),
    "nuclear": ("extended", "permit"),
    "storage": ("extended", "eeg", "permit"),
}

# Columns of the basic unit table.
BASIC_COLUMNS = [
    "EinheitMastrNummer",
    "DatumLetzteAktualisierung",
    "Name",
    "Einheitart",
    "Einheittyp",
    "Standort",
    "Bruttoleistung",
    "Erzeugungsleistung",
    "EinheitBetriebsstatus",
    "Anlagenbetreiber",
    "EegMastrNummer",
    "KwkMastrNummer",
    "SpeMastrNummer",
    "GenMastrNummer",
    "BestandsanlageMastrNummer",
    "NichtVorhandenInMigriertenEinheiten",
    "EinheitSystemstatus",
]

# Columns that hold catalog codes.
CODED_COLUMNS = [
    "AnlageBetriebsstatus",
    "Land",
    "Bundesland",
    "EinheitSystemstatus",
    "EinheitBetriebsstatus",
    "Energietraeger",
    "Einspeisungsart",
    "GemeinsamerWechselrichterMitSpeicher",
    "Lage",
    "Leistungsbegrenzung",
    "Hauptausrichtung",
    "HauptausrichtungNeigungswinkel",
    "Nutzungsbereich",
    "Nebenausrichtung",
    "NebenausrichtungNeigungswinkel",
    "ArtDerFlaecheIds",
    "AcDcKoppelung",
    "Batterietechnologie",
    "Technologie",
    "Pumpspeichertechnologie",
    "Einsatzort",
    "MarktakteurStatus",
    "Personenart",
    "Rechtsform",
    "HauptwirtdschaftszweigAbteilung",
    "HauptwirtdschaftszweigGruppe",
    "HauptwirtdschaftszweigAbschnitt",
    "Registergericht",
    "LandAnZustelladresse",
    "Gasqualitaet",
    "Spannungsebene",
    "ArtDerAenderung",
    "Hauptbrennstoff",
    "Biomasseart",
    "Speicherart",
    "Art",
    "ArtAbschaltbareLast",
    "WeitererHauptbrennstoff",
    "WeitereBrennstoffe",
    "ArtDerStilllegung",
    "ArtDesZuflusses",
    "ArtDerWasserkraftanlage",
    "Sparte",
    "Hersteller",
    "Seelage",
    "ClusterNordsee",
    "ClusterOstsee",
    "NetzbetreiberpruefungStatus",
]

# Columns by type. A column that no list names stays text, identifiers and columns new
# in an export among them.
DATES = [
    "Datum",
    "DatumBaubeginn",
    "DatumBeginnVoruebergehendeStilllegung",
    "DatumBeendigungVorlaeufigenStilllegung",
    "DatumEndgueltigeStilllegung",
    "DatumWiederaufnahmeBetrieb",
    "DatumUeberfuehrungInReserve",
    "DatumDesBetreiberwechsels",
    "DatumRegistrierungDesBetreiberwechsels",
    "DatumDownload",
    "Registrierungsdatum",
    "Inbetriebnahmedatum",
    "GeplantesInbetriebnahmedatum",
    "WiederinbetriebnahmeDatum",
    "EegInbetriebnahmedatum",
    "Meldedatum",
    "MieterstromRegistrierungsdatum",
    "MieterstromMeldedatum",
    "MieterstromErsteZuordnungZuschlag",
    "BiogasDatumInanspruchnahmeFlexiPraemie",
    "BiogasDatumLeistungserhoehung",
    "BiomethanErstmaligerEinsatz",
    "NetzbetreiberpruefungDatum",
    "NetzreserveAbDatum",
    "SicherheitsbereitschaftAbDatum",
    "WasserrechtAblaufdatum",
    "Frist",
    "Taetigkeitsbeginn",
    "Taetigkeitsende",
]

TIMESTAMPS = [
    "DatumLetzteAktualisierung",
    "DatumLetzeAktualisierung",
    "LetzteAenderung",
    "RegistrierungsdatumMarktakteur",
    "RegistrierungsdatumNetzbetreiberzuordnungsaenderung",
    "Netzbetreiberzuordnungsaenderungsdatum",
    "download_date",
    "request_date",
]

ABSENCE_FLAGS = [
    "AcerCode_nv",
    "AnlagenkennzifferAnlagenregister_nv",
    "BiogasGaserzeugungskapazitaet_nv",
    "BiomethanErstmaligerEinsatz_nv",
    "BundesnetzagenturBetriebsnummer_nv",
    "Fax_nv",
    "Frist_nv",
    "HausnummerAnZustelladresse_nv",
    "HausnummerNichtGefunden",
    "Hausnummer_nv",
    "Kraftwerksnummer_nv",
    "Marktpartneridentifikationsnummer_nv",
    "RegistrierungsnummerPvMeldeportal_nv",
    "StrasseNichtGefunden",
    "Taetigkeitsende_nv",
    "Umsatzsteueridentifikationsnummer_nv",
    "VerhaeltnisErtragsschaetzungReferenzertrag_nv",
    "VerhaeltnisReferenzertragErtrag10Jahre_nv",
    "VerhaeltnisReferenzertragErtrag15Jahre_nv",
    "VerhaeltnisReferenzertragErtrag5Jahre_nv",
    "WasserrechtAblaufdatum_nv",
    "Webseite_nv",
    "Weic_nv",
]

NUMBERS = set(
    """
    Breitengrad Laengengrad UtmEast UtmNorth GaussKruegerHoch GaussKruegerRechts
    Bruttoleistung Erzeugungsleistung Nettonennleistung NettonennleistungDeutschland InstallierteLeistung
    Nettoengpassleistung ElektrischeKwkLeistung ThermischeNutzleistung Hoechstbemessungsleistung Leistungserhoehung
    SteigerungNettonennleistungKombibetrieb ZugeordneteWirkleistungWechselrichter ZugeordneteGebotsmenge
    PumpbetriebLeistungsaufnahme LeistungsaufnahmeBeimEinspeichern NutzbareSpeicherkapazitaet Netzanschlusskapazitaet
    MaximalNutzbaresArbeitsgasvolumen MaximaleEinspeicherleistung MaximaleAusspeicherleistung
    MaximaleEinspeiseleistung MaximaleAusspeiseleistung MaximaleGasbezugsleistung DurchschnittlicherBrennwert
    AnteilBeinflussbareLast BiogasGaserzeugungskapazitaet BiogasUmfangLeistungserhoehung
    InAnspruchGenommeneFlaeche InAnspruchGenommeneLandwirtschaftlichGenutzteFlaeche
    Nabenhoehe Rotordurchmesser Wassertiefe Kuestenentfernung VerhaeltnisErtragsschaetzungReferenzertrag
    VerhaeltnisReferenzertragErtrag5Jahre VerhaeltnisReferenzertragErtrag10Jahre VerhaeltnisReferenzertragErtrag15Jahre
    """.split()
)
COUNTS = [
    "Id",
    "Kmu",
    "Weic_Na",
    "BilanzierungsgebietNetzanschlusspunktId",
    "AnzahlModule",
    "AnzahlNetzanschlusspunkte",
    "AnzahlStromverbrauchseinheitenGroesser50Mw",
]
FLAGS = set(
    """
    NichtVorhandenInMigriertenEinheiten AnschlussAnHoechstOderHochSpannung Schwarzstartfaehigkeit Inselbetriebsfaehigkeit
    FernsteuerbarkeitNb FernsteuerbarkeitDv FernsteuerbarkeitDr PraequalifiziertFuerRegelenergie PraequalifiziertGemaessAblav
    Rotorblattenteisungssystem AuflageAbschaltungLeistungsbegrenzung AuflagenAbschaltungSchallimmissionsschutzNachts
    AuflagenAbschaltungSchallimmissionsschutzTagsueber AuflagenAbschaltungSchattenwurf AuflagenAbschaltungTierschutz
    AuflagenAbschaltungEiswurf AuflagenAbschaltungSonstige Buergerenergie Nachtkennzeichen
    EinheitlicheAusrichtungUndNeigungswinkel AnlageIstImKombibetrieb AusschliesslicheVerwendungImKombibetrieb
    BestandteilGrenzkraftwerk Notstromaggregat MinderungStromerzeugung PumpbetriebKontinuierlichRegelbar
    AusschreibungZuschlag eegAusschreibungZuschlag PrototypAnlage PilotAnlage InanspruchnahmeZahlungNachEeg
    MieterstromZugeordnet AusschliesslicheVerwendungBiomasse BiogasInanspruchnahmeFlexiPraemie BiogasLeistungserhoehung
    Gasgrosshaendler Stromgrosshaendler BelieferungVonLetztverbrauchernGas BelieferungHaushaltskundenGas
    BelieferungVonLetztverbrauchernStrom BelieferungHaushaltskundenStrom Direktvermarktungsunternehmen NochInPlanung
    ErtuechtigungIstZulassungspflichtig
    """.split()
)


TYPES = {
    **dict.fromkeys(DATES, "date"),
    **dict.fromkeys(TIMESTAMPS, "timestamp"),
    **dict.fromkeys(COUNTS, "int"),
    **dict.fromkeys(sorted(NUMBERS), "double"),
    **dict.fromkeys([*sorted(FLAGS), *ABSENCE_FLAGS], "boolean"),
}


def type_of(column: str) -> str:
    return TYPES.get(column, "string")


def typed(df: DataFrame, types: dict[str, str] | None = None) -> DataFrame:
    """Cast text columns to their registry types; a value of the wrong type becomes NULL."""
    wanted = {c: (types or {}).get(c, type_of(c)) for c in df.columns}
    return df.withColumns({c: F.col(c).try_cast(k) for c, k in wanted.items() if k != "string"})


@dataclass(frozen=True)
class TableSpec:
    stem: str  # file name before the number, lower case
    table: str | None  # None: lookup only, never stored
    key: str | None = None
    renames: dict[str, str] = field(default_factory=dict)
    types: dict[str, str] = field(default_factory=dict)  # where a table differs from TYPES


_ONE_LINK = {"VerknuepfteEinheitenMaStRNummern": "VerknuepfteEinheit"}
_MANY_LINKS = {"VerknuepfteEinheitenMaStRNummern": "VerknuepfteEinheiten"}
_TEXT_DATES = {"Registrierungsdatum": "string", "Inbetriebnahmedatum": "string"}


def _ids(*names: str) -> dict[str, str]:
    """Spelling of id columns: `EegMaStRNummer` -> `EegMastrNummer`."""
    return {f"{n}MaStRNummer": f"{n}MastrNummer" for n in names}


# File stems, table names, primary keys and renames of the export.
TABLES = {
    s.stem: s
    for s in [
        TableSpec("einheitenwind", "wind_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg") | {"Nachtkennzeichnung": "Nachtkennzeichen"}),
        TableSpec("einheitensolar", "solar_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg") | _ONE_LINK),
        TableSpec("einheitenbiomasse", "biomass_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg", "Kwk")),
        TableSpec("einheitenwasser", "hydro_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg")),
        TableSpec("einheitengeothermiegrubengasdruckentspannung", "gsgk_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg", "Kwk")),
        TableSpec("einheitenverbrennung", "combustion_extended", "EinheitMastrNummer", _ids("Lokation", "Kwk")),
        TableSpec("einheitenkernkraft", "nuclear_extended", "EinheitMastrNummer", _ids("Lokation")),
        TableSpec("einheitenstromspeicher", "storage_extended", "EinheitMastrNummer", _ids("Lokation", "Eeg")),
        TableSpec("anlageneegwind", "wind_eeg", "EegMastrNummer", _ids("Eeg") | _ONE_LINK),
        TableSpec("anlageneegsolar", "solar_eeg", "EegMastrNummer", _ids("Eeg") | _ONE_LINK),
        TableSpec(
            "anlageneegbiomasse", "biomass_eeg", "EegMastrNummer",
            _ids("Eeg") | _ONE_LINK | {"BiogasHoechstbemessungsleistung": "Hoechstbemessungsleistung"},
        ),
        TableSpec("anlageneeggeothermiegrubengasdruckentspannung", "gsgk_eeg", "EegMastrNummer", _ids("Eeg") | _ONE_LINK),
        TableSpec("anlageneegwasser", "hydro_eeg", "EegMastrNummer", _ids("Eeg") | _ONE_LINK),
        TableSpec("anlageneegspeicher", "storage_eeg", "EegMastrNummer", _ids("Eeg") | _ONE_LINK | {"Zuschlagsnummer": "eegZuschlagsnummer"}),
        TableSpec("anlagenkwk", "kwk", "KwkMastrNummer", _MANY_LINKS),
        TableSpec("einheitengenehmigung", "permit", "GenMastrNummer", _MANY_LINKS),
        TableSpec("anlagenstromspeicher", "storage_units", "MastrNummer", {"MaStRNummer": "MastrNummer"} | _ONE_LINK),
        TableSpec("anlagengasspeicher", "gas_storage", "MastrNummer", {"MaStRNummer": "MastrNummer"} | _ONE_LINK),
        TableSpec("einheitengasspeicher", "gas_storage_extended", "EinheitMastrNummer", _ids("Lokation", "Speicher"), _TEXT_DATES),
        TableSpec("einheitengaserzeuger", "gas_producer", "EinheitMastrNummer", _ids("Lokation", "Speicher")),
        TableSpec("einheitengasverbraucher", "gas_consumer", "EinheitMastrNummer", _ids("Lokation") | _ONE_LINK, _TEXT_DATES),
        TableSpec("einheitenstromverbraucher", "electricity_consumer", "EinheitMastrNummer", _ids("Lokation"), _TEXT_DATES),
        TableSpec("lokationen", "locations_extended", "MastrNummer", _MANY_LINKS | {"NetzanschlusspunkteMaStRNummern": "Netzanschlusspunkte"}),
        TableSpec("marktakteure", "market_actors", "MastrNummer"),
        TableSpec("marktrollen", "market_roles", "MastrNummer"),
        TableSpec("netze", "grids", "MastrNummer"),
        TableSpec("netzanschlusspunkte", "grid_connections", "NetzanschlusspunktMastrNummer", _ids("Lokation", "Netz")),
        TableSpec("bilanzierungsgebiete", "balancing_area", "Id"),
        TableSpec("geloeschteunddeaktivierteeinheiten", "deleted_units", "EinheitMastrNummer"),
        TableSpec("geloeschteunddeaktiviertemarktakteure", "deleted_market_actors", "MarktakteurMastrNummer"),
        TableSpec("ertuechtigungen", "retrofit_units", "Id"),
        TableSpec("einheitenaenderungnetzbetreiberzuordnungen", "changed_dso_assignment", "EinheitMastrNummer"),
        TableSpec("katalogwerte", None),
        TableSpec("katalogkategorien", None),
        TableSpec("einheitentypen", None),
    ]
}

# Dataset names a user asks for and the files they need.
DATASETS = {
    "wind": ["anlageneegwind", "einheitenwind"],
    "solar": ["anlageneegsolar", "einheitensolar"],
    "biomass": ["anlageneegbiomasse", "einheitenbiomasse"],
    "hydro": ["anlageneegwasser", "einheitenwasser"],
    "gsgk": ["anlageneeggeothermiegrubengasdruckentspannung", "einheitengeothermiegrubengasdruckentspannung"],
    "combustion": ["anlagenkwk", "einheitenverbrennung"],
    "nuclear": ["einheitenkernkraft"],
    "storage": ["anlageneegspeicher", "einheitenstromspeicher"],
    "storage_units": ["anlagenstromspeicher"],
    "gas": ["anlagengasspeicher", "einheitengaserzeuger", "einheitengasspeicher", "einheitengasverbraucher"],
    "electricity_consumer": ["einheitenstromverbraucher"],
    "location": ["lokationen"],
    "market": ["marktakteure", "marktrollen"],
    "grid": ["netzanschlusspunkte", "netze"],
    "balancing_area": ["bilanzierungsgebiete"],
    "permit": ["einheitengenehmigung"],
    "deleted_units": ["geloeschteunddeaktivierteeinheiten"],
    "deleted_market_actors": ["geloeschteunddeaktiviertemarktakteure"],
    "retrofit_units": ["ertuechtigungen"],
    "changed_dso_assignment": ["einheitenaenderungnetzbetreiberzuordnungen"],
}

ADDITIONAL_TABLES = sorted(
    s.table
    for s in TABLES.values()
    if s.table and s.table != "kwk" and (s.table == "storage_units" or s.table.rsplit("_", 1)[0] not in TECHNOLOGY_ROLES)
)


def check_datasets(data: list[str] | str | None) -> list[str]:
    """The requested dataset names, all of them by default; unknown names are an error."""
    if data is None:
        return list(DATASETS)
    names = [data] if isinstance(data, str) else data
    if not isinstance(names, list) or not names or any(n not in DATASETS for n in names):
        raise ValueError(f"datasets must be a non-empty list out of {list(DATASETS)}")
    return names


def stems_of(data: list[str]) -> list[str]:
    return [stem for name in data for stem in DATASETS[name]]


def tables_of(data: list[str]) -> list[str]:
    return [TABLES[stem].table for stem in stems_of(data)]


def stem_of_file(path: str) -> tuple[str, int]:
    """`.../EinheitenSolar_12.xml` -> (`einheitensolar`, 12); no number counts as file 1."""
    name = path.replace("\\", "/").rsplit("/", 1)[-1].split(".")[0]
    stem, _, number = name.partition("_")
    return stem.lower(), int(number) if number.isdigit() else 1
