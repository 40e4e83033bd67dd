from feedspark.operators import feeds

HEAD = "poll_id string, request_started_at string, response_received_at string, header struct<timestamp:long,incrementality:int>"
STOP = "struct<stop_sequence:int,stop_id:string,arrival:struct<time:long,delay:int>>"
TRIP = f"struct<trip:struct<trip_id:string,route_id:string,schedule_relationship:int>,delay:int,stop_time_update:array<{STOP}>>"


def test_trip_updates(spark):
    ents = [("e1", False, (("t", "", 3), 5, [(4, "s", (100, 1)), (9, "s", None)])), ("e2", None, (("u", "r", 99), None, [(None, "a", None), (None, "b", None)])), ("e3", False, (("v", "r", None), None, [])), ("gone", True, None)]
    df = spark.createDataFrame([("p", None, "2024-01-01T00:00:00Z", (7, 0), ents)], f"{HEAD}, entities array<struct<id:string,is_deleted:boolean,trip_update:{TRIP}>>")
    rows = feeds.trip_updates(df).collect()
    assert len(rows[0]) == 57
    got = [(r.entity_id, r.stop_sequence, r.stop_visit_fallback_index, r.stop_time_update_index, r.stop_id, r.route_id, r.schedule_relationship_name) for r in rows]
    assert got == [
        ("e1", 4, None, 0, "s", None, "CANCELED"), ("e1", 9, None, 1, "s", None, "CANCELED"), ("e2", None, 0, 0, "a", "r", "99"), ("e2", None, 1, 1, "b", "r", "99"),
        ("e3", None, None, None, None, "r", None), ("gone", None, None, None, None, None, None),
    ]
    assert rows[0].request_started_at == "2024-01-01T00:00:00Z" and rows[0].arrival_time == 100 and rows[5].entity_is_deleted
    assert df.select(feeds.valid_poll("entities", "trip_update")).first()[0]


def test_vehicle_positions(spark):
    vehicle = "struct<vehicle:struct<id:string,bkk:struct<deviated:boolean>>,position:struct<latitude:float,longitude:float>,current_status:int>"
    ents = [("a", False, (("v1", (None,)), (47.5, 19.0), 2)), ("b", False, (("", None), None, 7)), ("c", True, None), ("d", False, None)]
    df = spark.createDataFrame([("p", "x", "y", (7, 1), ents)], f"{HEAD}, entities array<struct<id:string,is_deleted:boolean,vehicle:{vehicle}>>")
    rows = feeds.vehicle_positions(df).collect()
    assert len(rows[0]) == 45
    assert [(r.entity_id, r.vehicle_id, r.bkk_deviated, r.current_status_name, r.multi_carriage_details_json) for r in rows] == [("a", "v1", False, "IN_TRANSIT_TO", "[]"), ("b", None, None, "7", "[]"), ("c", None, None, None, None)]
    assert not df.select(feeds.valid_poll("entities", "vehicle")).first()[0]


def test_alerts(spark):
    alert = "struct<cause:int,header_text:struct<translation:array<struct<text:string,language:string>>>,active_period:array<struct<start:long,end:long>>,informed_entity:array<struct<route_id:string,stop_id:string>>>"
    ents = [("a", False, (1, ([("hi", "en")],), [(5, None)], [("r", None), (None, "s")])), ("b", False, (2, None, [], [])), ("c", True, None)]
    df = spark.createDataFrame([("p", "x", "y", (7, 0), ents)], f"{HEAD}, entities array<struct<id:string,is_deleted:boolean,alert:{alert}>>")
    got = [(r.entity_id, r.affected_route_id, r.affected_stop_id, r.header_text, r.active_period_start, r.informed_entities_json) for r in feeds.alerts(df).collect()]
    trip = "".join(f'"{n}":null,' for n in ("direction_id", "modified_trip_json", "route_id", "schedule_relationship", "schedule_relationship_name", "start_date", "start_time", "trip_id"))[:-1]
    one = lambda route, stop: f'{{"agency_id":null,"direction_id":null,"route_id":{route},"route_type":null,"stop_id":{stop},"trip":{{{trip}}}}}'
    both = f'[{one(chr(34) + "r" + chr(34), "null")},{one("null", chr(34) + "s" + chr(34))}]'
    assert got == [("a", "r", None, "hi", 5, both), ("a", None, "s", "hi", 5, both), ("b", None, None, None, None, "[]"), ("c", None, None, None, None, None)]
    first = feeds.alerts(df).filter("entity_id = 'a'").first()
    assert (first.cause_name, first.active_periods_json, first.header_text_json, first.impact_periods_json) == ("UNKNOWN_CAUSE", '[{"end":null,"start":5}]', '[{"language":"en","text":"hi"}]', "[]")
