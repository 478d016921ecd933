"""Small lookup tables shipped with the library.

Fixed values. They come from the published data dictionary of the incident
feed and have to be equal to it for right results: district populations per
year, offence groups, descent codes and severity codes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Residents per police area and year.
POPULATION = {
    "WILSHIRE": {2020: 143600, 2021: 144080, 2022: 144570, 2023: 145320},
    "CENTRAL": {2020: 180700, 2021: 181300, 2022: 182150, 2023: 182765},
    "SOUTHWEST": {2020: 118100, 2021: 118400, 2022: 118750, 2023: 118940},
    "VAN NUYS": {2020: 163500, 2021: 164300, 2022: 165100, 2023: 165732},
    "HOLLENBECK": {2020: 136900, 2021: 137400, 2022: 137880, 2023: 138210},
    "RAMPART": {2020: 139400, 2021: 139900, 2022: 140500, 2023: 140875},
    "NEWTON": {2020: 108000, 2021: 108500, 2022: 109000, 2023: 109432},
    "NORTHEAST": {2020: 94500, 2021: 95000, 2022: 95500, 2023: 95678},
    "77TH STREET": {2020: 105800, 2021: 106400, 2022: 106900, 2023: 107215},
    "HOLLYWOOD": {2020: 130800, 2021: 131500, 2022: 132200, 2023: 132540},
    "HARBOR": {2020: 135300, 2021: 135800, 2022: 136500, 2023: 136890},
    "WEST VALLEY": {2020: 160400, 2021: 161100, 2022: 161900, 2023: 162305},
    "WEST LA": {2020: 130900, 2021: 131500, 2022: 132100, 2023: 132450},
    "N HOLLYWOOD": {2020: 154800, 2021: 155700, 2022: 156500, 2023: 156780},
    "PACIFIC": {2020: 68700, 2021: 69000, 2022: 69300, 2023: 69540},
    "DEVONSHIRE": {2020: 124500, 2021: 125100, 2022: 125700, 2023: 125890},
    "MISSION": {2020: 158500, 2021: 159300, 2022: 160000, 2023: 160432},
    "SOUTHEAST": {2020: 123700, 2021: 124100, 2022: 124500, 2023: 124765},
    "OLYMPIC": {2020: 82000, 2021: 82500, 2022: 83000, 2023: 83210},
    "FOOTHILL": {2020: 88500, 2021: 89000, 2022: 89500, 2023: 89765},
    "TOPANGA": {2020: 127100, 2021: 127700, 2022: 128300, 2023: 128540},
}

# Offence description -> group.
OFFENCE_GROUPS = {
    "VIOLENT CRIMES": [
        "ARSON",
        "ASSAULT WITH DEADLY WEAPON ON POLICE OFFICER",
        "ASSAULT WITH DEADLY WEAPON",
        "AGGRAVATED ASSAULT",
        "ATTEMPTED ROBBERY",
        "BATTERY - SIMPLE ASSAULT",
        "BATTERY ON A FIREFIGHTER",
        "BATTERY POLICE (SIMPLE)",
        "BRANDISH WEAPON",
        "CRIMINAL HOMICIDE",
        "CRIMINAL THREATS - NO WEAPON DISPLAYED",
        "DISCHARGE FIREARMS/SHOTS FIRED",
        "DRUNK ROLL",
        "EXTORTION",
        "FALSE IMPRISONMENT",
        "HUMAN TRAFFICKING - COMMERCIAL SEX ACTS",
        "HUMAN TRAFFICKING - INVOLUNTARY SERVITUDE",
        "INTIMATE PARTNER - AGGRAVATED ASSAULT",
        "INTIMATE PARTNER - SIMPLE ASSAULT",
        "KIDNAPPING",
        "KIDNAPPING - GRAND ATTEMPT",
        "LYNCHING",
        "LYNCHING - ATTEMPTED",
        "MANSLAUGHTER, NEGLIGENT",
        "OTHER ASSAULT",
        "ROBBERY",
        "SHOTS FIRED AT INHABITED DWELLING",
        "SHOTS FIRED AT MOVING VEHICLE, TRAIN OR AIRCRAFT",
        "STALKING",
        "THREATENING PHONE CALLS/LETTERS",
        "THROWING OBJECT AT MOVING VEHICLE",
        "WEAPONS POSSESSION/BOMBING",
    ],
    "PROPERTY CRIMES": [
        "BIKE - ATTEMPTED STOLEN",
        "BIKE - STOLEN",
        "BOAT - STOLEN",
        "BURGLARY",
        "BURGLARY FROM VEHICLE",
        "BURGLARY FROM VEHICLE, ATTEMPTED",
        "BURGLARY, ATTEMPTED",
        "DEFRAUDING INNKEEPER/THEFT OF SERVICES, $950 & UNDER",
        "DEFRAUDING INNKEEPER/THEFT OF SERVICES, OVER $950.01",
        "DISHONEST EMPLOYEE - GRAND THEFT",
        "DISHONEST EMPLOYEE - PETTY THEFT",
        "DISHONEST EMPLOYEE ATTEMPTED THEFT",
        "DRIVING WITHOUT OWNER CONSENT (DWOC)",
        "GRAND THEFT / AUTO REPAIR",
        "PETTY THEFT - AUTO REPAIR",
        "PICKPOCKET",
        "PICKPOCKET, ATTEMPT",
        "PURSE SNATCHING",
        "PURSE SNATCHING - ATTEMPT",
        "SHOPLIFTING - ATTEMPT",
        "SHOPLIFTING - PETTY THEFT ($950 & UNDER)",
        "SHOPLIFTING-GRAND THEFT ($950.01 & OVER)",
        "TELEPHONE PROPERTY - DAMAGE",
        "THEFT FROM MOTOR VEHICLE - ATTEMPT",
        "THEFT FROM MOTOR VEHICLE - GRAND ($950.01 AND OVER)",
        "THEFT FROM MOTOR VEHICLE - PETTY ($950 & UNDER)",
        "THEFT FROM PERSON - ATTEMPT",
        "THEFT PLAIN - ATTEMPT",
        "THEFT PLAIN - PETTY ($950 & UNDER)",
        "THEFT-GRAND ($950.01 & OVER)EXCPT,GUNS,FOWL,LIVESTK,PROD",
        "THEFT, COIN MACHINE - ATTEMPT",
        "THEFT, COIN MACHINE - GRAND ($950.01 & OVER)",
        "THEFT, COIN MACHINE - PETTY ($950 & UNDER)",
        "THEFT, PERSON",
        "TILL TAP - GRAND THEFT ($950.01 & OVER)",
        "TILL TAP - PETTY ($950 & UNDER)",
        "TRESPASSING",
        "VANDALISM - FELONY ($400 & OVER, ALL CHURCH VANDALISMS)",
        "VANDALISM - MISDEAMEANOR ($399 OR UNDER)",
        "VEHICLE - ATTEMPT STOLEN",
        "VEHICLE - STOLEN",
        "VEHICLE, STOLEN - OTHER (MOTORIZED SCOOTERS, BIKES, ETC)",
    ],
    "SEX CRIMES": [
        "BATTERY WITH SEXUAL CONTACT",
        "BEASTIALITY, CRIME AGAINST NATURE SEXUAL ASSLT WITH ANIM",
        "INDECENT EXPOSURE",
        "LEWD CONDUCT",
        "ORAL COPULATION",
        "PANDERING",
        "PEEPING TOM",
        "PIMPING",
        "RAPE, ATTEMPTED",
        "RAPE, FORCIBLE",
        "SEX OFFENDER REGISTRANT OUT OF COMPLIANCE",
        "SEX,UNLAWFUL(INC MUTUAL CONSENT, PENETRATION W/ FRGN OBJ)",
        "SEXUAL PENETRATION W/FOREIGN OBJECT",
        "SODOMY/SEXUAL CONTACT B/W PENIS OF ONE PERS TO ANUS OTH",
    ],
    "CRIMES AGAINST CHILDREN": [
        "CHILD ABANDONMENT",
        "CHILD ABUSE (PHYSICAL) - AGGRAVATED ASSAULT",
        "CHILD ABUSE (PHYSICAL) - SIMPLE ASSAULT",
        "CHILD ANNOYING (17YRS & UNDER)",
        "CHILD NEGLECT (SEE 300 W.I.C.)",
        "CHILD PORNOGRAPHY",
        "CHILD STEALING",
        "CONTRIBUTING",
        "CRM AGNST CHLD (13 OR UNDER) (14-15 & SUSP 10 YRS OLDER)",
        "DRUGS, TO A MINOR",
        "INCEST (SEXUAL ACTS BETWEEN BLOOD RELATIVES)",
        "LEWD/LASCIVIOUS ACTS WITH CHILD",
        "LETTERS, LEWD - TELEPHONE CALLS, LEWD",
    ],
    "FRAUD & FINANCIAL CRIMES": [
        "BUNCO, ATTEMPT",
        "BUNCO, GRAND THEFT",
        "BUNCO, PETTY THEFT",
        "COUNTERFEIT",
        "CREDIT CARDS, FRAUD USE ($950 & UNDER",
        "CREDIT CARDS, FRAUD USE ($950.01 & OVER)",
        "DOCUMENT FORGERY / STOLEN FELONY",
        "DOCUMENT WORTHLESS ($200 & UNDER)",
        "DOCUMENT WORTHLESS ($200.01 & OVER)",
        "EMBEZZLEMENT, GRAND THEFT ($950.01 & OVER)",
        "EMBEZZLEMENT, PETTY THEFT ($950 & UNDER)",
        "GRAND THEFT / INSURANCE FRAUD",
        "THEFT OF IDENTITY",
        "UNAUTHORIZED COMPUTER ACCESS",
    ],
    "CRIMES AGAINST PUBLIC ORDER & SAFETY": [
        "BIGAMY",
        "BLOCKING DOOR INDUCTION CENTER",
        "BOMB SCARE",
        "CRUELTY TO ANIMALS",
        "DISRUPT SCHOOL",
        "DISTURBING THE PEACE",
        "FAILURE TO DISPERSE",
        "FAILURE TO YIELD",
        "ILLEGAL DUMPING",
        "INCITING A RIOT",
        "OTHER MISCELLANEOUS CRIME",
        "PROWLER",
        "RECKLESS DRIVING",
        "REPLICA FIREARMS(SALE,DISPLAY,MANUFACTURE OR DISTRIBUTE)",
    ],
    "CRIMES AGAINST JUSTICE & GOVERNMENT": [
        "BRIBERY",
        "CONSPIRACY",
        "CONTEMPT OF COURT",
        "FALSE POLICE REPORT",
        "FIREARMS EMERGENCY PROTECTIVE ORDER (FIREARMS EPO)",
        "FIREARMS RESTRAINING ORDER (FIREARMS RO)",
        "RESISTING ARREST",
        "VIOLATION OF COURT ORDER",
        "VIOLATION OF RESTRAINING ORDER",
        "VIOLATION OF TEMPORARY RESTRAINING ORDER",
    ],
}

# Single-letter descent codes.
DESCENT_SINGLE = {"W": "White", "B": "Black", "H": "Hispanic"}
DESCENT_ASIAN = ["A", "C", "D", "F", "G", "I", "J", "K", "L", "P", "S", "U", "V", "Z"]
DESCENT_DEFAULT = "Other"

# Report class -> severity.
SEVERITY = {1: "Serious", 2: "Less Serious"}


def population(spark: SparkSession) -> DataFrame:
    """(area, year, population), 84 rows."""
    rows = [(area, year, n) for area, by_year in POPULATION.items() for year, n in by_year.items()]
    return spark.createDataFrame(rows, "area string, year int, population bigint")


def offence_groups(spark: SparkSession) -> DataFrame:
    """(offence, category), 139 rows."""
    rows = [(offence, group) for group, offences in OFFENCE_GROUPS.items() for offence in offences]
    return spark.createDataFrame(rows, "offence string, category string")
