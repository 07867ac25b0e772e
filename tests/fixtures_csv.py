"""Hand-written edge rows per table with the expected cleaning outcome.

Expected: 'keep', 'null' (required-field filter) or the first failing rule.
"""

ENCOUNTERS = """Id,START,STOP,PATIENT,ORGANIZATION,PROVIDER,PAYER,ENCOUNTERCLASS,CODE,DESCRIPTION,BASE_ENCOUNTER_COST,TOTAL_CLAIM_COST,PAYER_COVERAGE,REASONCODE,REASONDESCRIPTION
e1,2020-01-01T10:00:00Z,2020-01-01T10:15:00Z,p1,o1,d1,y1,wellness,1,Check,100,150,50,,
e2,2020-01-02T10:00:00Z,,p1,o1,d1,y1,emergency,2,Open end,100,100,100,null, r
e3,2020-01-03T10:00:00Z,2020-01-02T10:00:00Z,p2,o1,d1,y1,inpatient,3,Backwards,10,20,5,,
e4,2020-01-04T10:00:00Z,,p2,o1,d1,y1,outpatient,4,Class,10,20,5,,
e5,2020-01-05T10:00:00Z,,p2,o1,d1,y1,wellness,5,Base over total,30,20,5,,
e6,2020-01-06T10:00:00Z,,p2,o1,d1,y1,wellness,6,Cover over total,10,20,25,,
e7,not-a-time,,p2,o1,d1,y1,wellness,7,Bad start,10,20,5,,
e8,2020-01-08T10:00:00Z,,null,o1,d1,y1,wellness,8,No patient,10,20,5,,
e9,2020-01-09T10:00:00Z,,p2,o1,d1,y1,wellness,9,Negative,-1,20,5,,
"""
ENCOUNTERS_EXPECTED = {
    "e1": "keep", "e2": "keep", "e3": "date_range_stop_after_start", "e4": "encounter_class_set",
    "e5": "base_cost_<=_total", "e6": "payer_amnt_<=_total", "e7": "null", "e8": "null",
    "e9": "base_cost_nonNeg",
}
ENCOUNTERS_SUMMARY = (9, 2, 5, 2)

MEDICATIONS = """START,STOP,PATIENT,PAYER,ENCOUNTER,CODE,DESCRIPTION,BASE_COST,PAYER_COVERAGE,DISPENSES,TOTALCOST,REASONCODE,REASONDESCRIPTION
2020-01-01T10:00:00Z,,p1,y1,e1,m1,Plain,10,5,3,30,,
2020-01-01T10:00:00Z,,p1,y1,e1,m2,At tolerance,10,5,3,33,,
2020-01-01T10:00:00Z,,p1,y1,e1,m3,Over tolerance,10,5,3,33.01,,
2020-01-01T10:00:00Z,,p1,y1,e1,m4,Under base,10,5,3,9.99,,
2020-01-01T10:00:00Z,,p1,y1,e1,m5,No fills,10,5,0,10,,
2020-01-01T10:00:00Z,,p1,y1,e1,m6,Cover over total,10,31,3,30,,
2020-01-01T10:00:00Z,,p1,y1,e1,m7,Bad int,10,5,x,30,,
2020-02-01T10:00:00Z,,p1,y1,e1,m1,Same key as row 1,10,5,3,30,,
2020-01-01T10:00:00Z,,p9,y1,e4,m8,Orphans,10,5,3,30,,
"""
MEDICATIONS_EXPECTED = {
    "Plain": "keep", "At tolerance": "keep",
    "Over tolerance": "totalcost_consistent_with_base_and_dispenses",
    "Under base": "totalcost_consistent_with_base_and_dispenses",
    "No fills": "dispenses_positive", "Cover over total": "payer_coverage_<=_totalcost",
    "Bad int": "null", "Same key as row 1": "keep", "Orphans": "keep",
}
MEDICATIONS_SUMMARY = (9, 1, 4, 4)

ORGANIZATIONS = """Id,NAME,ADDRESS,CITY,STATE,ZIP,LAT,LON,PHONE,REVENUE,UTILIZATION
o1,Clinic,1 Main,Boston,MA,02101,42.3,-71.0,555-1000 Or 555-2000 Or 555-3000,100,5
o2,NoState,2 Main,Boston,,,,,,0,0
o3,Lower,3 Main,Boston,ma,,,,,1,1
o4,BadLat,4 Main,Boston,MA,,90.5,0,,1,1
o5,BadLon,5 Main,Boston,MA,,0,-180.5,,1,1
o6,Negative,6 Main,Boston,MA,,0,0,,-1,1
o7,Blank,   ,Boston,MA,,0,0,,1,1
o8,NanLat,8 Main,Boston,MA,,NaN,0,,1,1
"""
ORGANIZATIONS_EXPECTED = {
    "o1": "keep", "o2": "keep", "o3": "state_valid_format", "o4": "lat_valid_range",
    "o5": "lon_valid_range", "o6": "revenue_nonNeg", "o7": "keep", "o8": "lat_valid_range",
}
ORGANIZATIONS_SUMMARY = (8, 0, 5, 3)

PATIENTS = """Id,BIRTHDATE,DEATHDATE,SSN,DRIVERS,PASSPORT,PREFIX,FIRST,MIDDLE,LAST,SUFFIX,MAIDEN,MARITAL,RACE,ETHNICITY,GENDER,BIRTHPLACE,ADDRESS,CITY,STATE,COUNTY,FIPS,ZIP,LAT,LON,HEALTHCARE_EXPENSES,HEALTHCARE_COVERAGE,INCOME
p1,1980-05-01,,s1,,,,Ann,,Lee,,,M,white,nonhispanic,F,Boston,1 Elm,Boston,MA,,,,42,-71,10,5,50000
p2,1981-05-01,2020-01-01,s2,,,,Bo,,Kim,,,,asian,nonhispanic,M,Boston,2 Elm,Boston,MA,,,,42,-71,10,5,50000
p3,1982-05-01,,s3,,,,Cy,,Roe,,,X,white,hispanic,M,Boston,3 Elm,Boston,MA,,,,42,-71,10,5,50000
p4,1983-05-01,,s4,,,,Di,,Poe,,,S,white,hispanic,U,Boston,4 Elm,Boston,MA,,,,42,-71,10,5,50000
p5,1984-05-01,,s5,,,,Ed,,Fox,,,D,white,hispanic,M,Boston,5 Elm,Boston,MA,,,,42,-71,-10,5,50000
p6,1985-05-01,,,,,,Flo,,Ray,,,W,white,hispanic,F,Boston,6 Elm,Boston,MA,,,,42,-71,10,5,50000
p1,1980-05-01,,s1,,,,Ann,,Lee,,,M,white,nonhispanic,F,Boston,1 Elm,Boston,MA,,,,42,-71,10,5,50000
"""
PATIENTS_EXPECTED = {
    "p2": "keep", "p3": "valid_marital", "p4": "valid_gender", "p5": "healthcare_expenses_nonNeg", "p6": "null",
}
PATIENTS_SUMMARY = (7, 1, 4, 2)

CSV = {"encounters": ENCOUNTERS, "medications": MEDICATIONS, "organizations": ORGANIZATIONS, "patients": PATIENTS}
