"""Source schemas: header spellings and JSON fields. Fixed values, as the files name them."""

MASTER = {
    "n_number": ["N-NUMBER"],
    "serial": ["SERIAL NUMBER", "SERIAL-NUMBER"],
    "code": ["MFR MDL CODE"],
    "engine_code": ["ENG MFR MDL"],
    "year": ["YEAR MFR"],
    "registrant_type": ["TYPE REGISTRANT"],
    "registrant": ["NAME"],
    "street": ["STREET"],
    "street2": ["STREET2"],
    "city": ["CITY"],
    "state": ["STATE"],
    "zip": ["ZIP CODE"],
    "region": ["REGION"],
    "county": ["COUNTY"],
    "country": ["COUNTRY"],
    "last_action_date": ["LAST ACTION DATE"],
    "cert_issue_date": ["CERT ISSUE DATE"],
    "certification": ["CERTIFICATION"],
    "aircraft_type": ["TYPE AIRCRAFT"],
    "engine_type": ["TYPE ENGINE"],
    "status_code": ["STATUS CODE"],
    "mode_s_code": ["MODE S CODE"],
    "fract_owner": ["FRACT OWNER"],
    "air_worth_date": ["AIR WORTH DATE"],
    **{f"other_name_{k}": [f"OTHER NAMES({k})"] for k in range(1, 6)},
    "expiration_date": ["EXPIRATION DATE"],
    "unique_id": ["UNIQUE ID"],
    "kit": ["KIT MFR, KIT MODEL"],
    "kit_mfr": ["KIT MFR"],
    "kit_model": ["KIT MODEL"],
    "mode_s_code_hex": ["MODE S CODE HEX"],
}
ACFTREF = {"code": ["CODE"], "manufacturer": ["MFR"], "model": ["MODEL"], "aircraft_type": ["TYPE-ACFT"], "engine_type": ["TYPE-ENG"], "category": ["AC-CAT"], "builder": ["BUILD-CERT-IND"], "engines": ["NO-ENG"], "seats": ["NO-SEATS"], "weight": ["AC-WEIGHT"], "speed": ["SPEED"], "tc_data_sheet": ["TC-DATA-SHEET"], "tc_data_holder": ["TC-DATA-HOLDER"]}
ENGINE = {"code": ["CODE"], "manufacturer": ["MFR"], "model": ["MODEL"], "type": ["TYPE"], "horsepower": ["HORSEPOWER"], "thrust": ["THRUST"]}
DEALER = {"certificate_number": ["CERTIFICATE-NUMBER"], "ownership": ["OWNERSHIP"], "certificate_date": ["CERTIFICATE-DATE"], "expiration_date": ["EXPIRATION-DATE"], "expiration_flag": ["EXPIRATION-FLAG"], "issue_count": ["CERTIFICATE-ISSUE-COUNT"], "name": ["NAME"], "street": ["STREET"], "street2": ["STREET2"], "city": ["CITY"], "state": ["STATE-ABBREV"], "zip": ["ZIP-CODE"], **{f"other_name_{k}": [f"OTHER-NAMES-{k}"] for k in range(1, 26)}}
MAILING = {f"{name}_{kind}": [f"{spelling}-{kind.upper()}"] for kind in ("mail", "physical") for name, spelling in (("street", "STREET"), ("street2", "STREET2"), ("city", "CITY"), ("state", "STATE-ABBREV"), ("zip", "ZIP-CODE"), ("county", "COUNTY"), ("country", "COUNTRY"))}
DEREG = {**MAILING, "n_number": ["N-NUMBER", "N_NUMBER"], "serial": ["SERIAL-NUMBER", "SERIAL NUMBER"], "code": ["MFR-MDL-CODE"], "status_code": ["STATUS-CODE"], "name": ["NAME"], "engine_code": ["ENG-MFR-MDL"], "year": ["YEAR-MFR"], "certification": ["CERTIFICATION"], "region": ["REGION"], "air_worth_date": ["AIR-WORTH-DATE"], "cancel_date": ["CANCEL-DATE"], "mode_s_code": ["MODE-S-CODE"], "indicator_group": ["INDICATOR-GROUP"], "export_country": ["EXP-COUNTRY"], "last_action_date": ["LAST-ACT-DATE"], "cert_issue_date": ["CERT-ISSUE-DATE"], **{f"other_name_{k}": [f"OTHER-NAMES({k})"] for k in range(1, 6)}, "kit": ["KIT MFR, KIT MODEL"], "mode_s_code_hex": ["MODE S CODE HEX"]}
DOCINDEX = {"collateral_type": ["TYPE-COLLATERAL"], "collateral": ["COLLATERAL"], "party": ["PARTY"], "doc_id": ["DOC-ID", "DOC_ID"], "drdate": ["DRDATE"], "processing_date": ["PROCESSING-DATE"], "corr_date": ["CORR-DATE"], "corr_id": ["CORR-ID"], "serial_id": ["SERIAL-ID"], "doc_type": ["DOC-TYPE"]}
RESERVED = {"n_number": ["N-NUMBER", "N_NUMBER"], "registrant": ["REGISTRANT"], "street": ["STREET"], "street2": ["STREET2"], "city": ["CITY"], "state": ["STATE"], "zip": ["ZIP CODE"], "rsv_date": ["RSV DATE"], "type_reservation": ["TR"], "exp_date": ["EXP DATE"], "n_number_change": ["N-NUM-CHG"], "purge_date": ["PURGE DATE"]}

#: Registry files beside MASTER: table, file, columns, key, whole numbers, dates, and whether a held key stays as it is.
REGISTRY_FILES = (
    ("aircraft_reference", "ACFTREF.txt", ACFTREF, "code", ("engines", "seats"), (), False),
    ("dealers", "DEALER.txt", DEALER, "certificate_number", ("ownership", "issue_count"), ("certificate_date", "expiration_date"), False),
    ("deregistered", "DEREG.txt", DEREG, "serial", ("year",), ("air_worth_date", "cancel_date", "last_action_date", "cert_issue_date"), True),
    ("engine_reference", "ENGINE.txt", ENGINE, "code", ("horsepower", "thrust"), (), False),
    ("document_index", "DOCINDEX.txt", DOCINDEX, "serial_id", ("collateral_type",), ("drdate", "processing_date", "corr_date"), True),
    ("reserved", "RESERVED.txt", RESERVED, "n_number", (), ("rsv_date", "exp_date", "purge_date"), True),
)
#: Sources in load order, as their folders are named, and the files of the undated one.
SOURCES = ("controller", "aircraftexchange", "faa", "internaldb", "aviacost")
FLEET_FILE, SALES_FILE = "aircraft.csv", "recent_sales.csv"

#: Fleet CSV: header -> (column, type).
FLEET = {
    "Serial Number": ("serial_number", "string"),
    "Registration Number": ("registration_number", "string"),
    "Make": ("manufacturer", "string"),
    "Model": ("model", "string"),
    "Manufacturer Year": ("manufacturer_year", "int"),
    "Delivery Year": ("delivery_year", "int"),
    "Category": ("category", "string"),
    "Aircraft Status": ("aircraft_status", "string"),
    "Transaction Status": ("transaction_status", "string"),
    "Ask Price": ("ask_price", "string"),
    "Take Price": ("take_price", "string"),
    "Sold Price": ("sold_price", "string"),
    "Airframe Total Time": ("airframe_total_time", "decimal(14,2)"),
    "APU Total Time": ("apu_total_time", "decimal(14,2)"),
    "Prop Total Time": ("prop_total_time", "decimal(14,2)"),
    "Engine Program": ("engine_program", "string"),
    "Engine Program Deferment": ("engine_program_deferment", "string"),
    "Engine Program Deferment Amount": ("engine_program_deferment_amount", "decimal(18,2)"),
    "APU Program": ("apu_program", "string"),
    "APU Program Deferment": ("apu_program_deferment", "string"),
    "APU Program Deferment Amount": ("apu_program_deferment_amount", "decimal(18,2)"),
    "Airframe Program": ("airframe_program", "string"),
    "Maintenance Tracking Program": ("maintenance_tracking_program", "string"),
    "Registration Country": ("registration_country", "string"),
    "Based Country": ("based_country", "string"),
    "Number of Passengers": ("number_of_passengers", "int"),
    "Date Listed": ("date_listed", "date"),
    "Interior Year": ("interior_year", "int"),
    "Exterior Year": ("exterior_year", "int"),
    "Seller Broker": ("seller_broker", "string"),
    "Buyer Broker": ("buyer_broker", "string"),
    "Seller": ("seller", "string"),
    "Buyer": ("buyer", "string"),
    "Updated at": ("source_updated_at", "date"),
    "Updated by": ("updated_by", "string"),
    "Has Damage": ("has_damage", "string"),
    "Feature Source": ("feature_source", "string"),
    "Features": ("features", "string"),
    "Next Inspections": ("next_inspections", "string"),
}
#: Marketplace feeds.
INDEX_FEED = "listing_url string, listing_id string, aircraft_model string, year string, listing_location string, listing_price string, total_time_hours string, seller_name string, seller_phone string, seller_email string, is_premium_listing boolean, payment_estimate string, page_url string, position int"
DETAIL_FEED = (
    "listing_url string, year string, manufacturer string, model string, serial_number string, registration_number string, condition string, description string, asking_price string, location string, total_time string, "
    "engine1_make_model string, engine1_serial_number string, engine1_tbo string, engine2_make_model string, engine2_serial_number string, engine2_tbo string, apu string, avionics string, equipment string, props string"
)
COST_FEED = (
    "aircraftDetailId int, name string, description string, aircraftManufacturer struct<aircraftManufacturerId: int, name: string>, aircraftCategory struct<aircraftCategoryId: int, category: string>, avionics string, yearsInProduction string, "
    "averagePreOwnedPrice double, totalVariableCostPerHrsValue double, calc_TotalVariableCostPerHour double, fuelGallons double, normalCruiseSpeedKts double, seatsFullRangeNm double, typicalPassengerCapacityMax int, maxTakeoffWeight double, powerplant string, model string, lastUpdatedOn string"
)
FLEET_PAGES = "make_model_id int, make_model_name string, serial_number string, aircraft_entity_id int, fields map<string, string>, sections map<string, string>"
SALES = {
    **{h: FLEET[h] for h in ("Serial Number", "Registration Number", "Make", "Model", "Manufacturer Year", "Delivery Year", "Category", "Transaction Status", "Engine Program", "Engine Program Deferment Amount", "APU Program", "APU Program Deferment Amount", "Airframe Program", "Seller", "Buyer", "Seller Broker", "Buyer Broker", "Has Damage", "Features")},
    "Sold Price": ("sold_price", "decimal(15,2)"),
    "Ask Price": ("ask_price", "decimal(15,2)"),
    "Take Price": ("take_price", "decimal(15,2)"),
    "Date Sold": ("date_sold", "date"),
    "Days on market": ("days_on_market", "int"),
    "% of Book": ("percent_of_book", "decimal(5,2)"),
}
