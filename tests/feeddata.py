"""Small hand-written feed files that contain the irregularities the jobs must handle."""

from pathlib import Path

HEADERS = {
    "adp_shifts": "shift_id,community_id,employee_id,role,shift_date,hours_worked,hourly_rate",
    "gbp_reviews": "review_id,community_id,review_date,rating,review_text,response_text,responded_at",
    "hubspot_leads": "lead_id,community_id,lead_source,created_date,tour_date,deposit_date,move_in_date,status,lost_reason",
    "pcc_care_history": "resident_id,change_date,previous_level,new_level,reason",
    "pcc_incidents": "incident_id,resident_id,community_id,incident_date,incident_type,severity,reported_by",
    "pcc_residents": "resident_id,community_id,first_name,last_name,dob,gender,admit_date,discharge_date,care_level,"
    "acuity_score,mobility_status",
    "yardi_leases": "lease_id,resident_id,unit_id,community_id,move_in_date,move_out_date,move_out_reason,monthly_rate",
    "yardi_units": "unit_id,community_id,unit_type,monthly_rent,snapshot_date",
}

RATES = "\"{'Caregiver':16, 'RN':46, 'Med Tech':None}\""

JANUARY = {
    "adp_shifts": [
        f" S1 ,C001,E1, caregiver,2025-01-06,8,{RATES}",
        f"S2,C001,E1,RN,2025-01-07,4,{RATES}",  # E1 has two roles
        f"S3,C002,E2,Med Tech,2025-01-08,-2,{RATES}",  # no rate, negative hours
        f",C002,E2,RN,2025-01-08,9,{RATES}",  # no shift id: dropped
    ],
    "gbp_reviews": [
        'G1,C001,2025-01-10,5,"Great, really\nkind ""people""",Thank you,2025-01-12',
        "G2,C001,2025-01-11,6,Fine,   ,2025-01-12",  # rating out of range, blank answer
        "G3,C905,2025-01-12,4,Fine,,",  # unmapped community
    ],
    "hubspot_leads": [
        "H1,C001, print ,2025/01/06,,,2025-03-01,Won,",
        "H2,C001,Web,someday,,,,lost,Price",
    ],
    "pcc_care_history": [
        "R1,2025-01-08,,AL,Admission",
        "R2,2025-01-02,,IL,Admission",
        "R2,2025-03-01,IL,AL,Acuity Increase",
    ],
    "pcc_incidents": ["I1,R1,C001,2025-01-15,Fall,2,E1", "I2,R9,C001,2099-01-04,Other,3,E1"],
    "pcc_residents": [
        "R1,C001,Ann,Old,1940-01-01,f,2024-12-01,,AL,3,Walker",
        "R2,C002,Bob,Same,1941-01-01,M,2025-01-01,2024-12-31, memory ,9,Chair",  # discharged before admit, acuity 9
    ],
    "yardi_leases": [
        "L1,R1,U1,C001,2024-12-01,,,4000",
        "L2,R2,U2,C002,2025-01-01,2025-02-10, Financial ,3500.5",
        "L3,R2,U2,C002,2024-01-01,2024-02-10,Moved,3000",
        "L4,R9,U3,C002,2024-01-01,2025-02-11,,3100",  # unknown resident, no reason
        "L5,R2,U2,C002,2023-01-01,2024-02-09,Moved,3000",  # one day outside the trailing 12 months
    ],
    "yardi_units": ["U1,C001,AL,4000,2025-01-01", "U2,C002,MC,0,2025-01-01", "U3,C905,IL,3900,2025-01-01"],
}

FEBRUARY = {
    "pcc_residents": ["R1,C002,Ann,New,1940-01-01,F,2024-12-01,,Assisted,4,Walker"],
    "yardi_leases": ["L2,R2,U2,C002,2025-01-01,2025-02-10, Financial ,3500.5"],  # the same row as in January
}


def write(folder: Path, period: str, feeds: dict[str, list[str]]) -> None:
    folder.mkdir(parents=True, exist_ok=True)
    for feed, lines in feeds.items():
        (folder / f"{feed}_{period}.csv").write_text("\n".join([HEADERS[feed], *lines]) + "\n")
