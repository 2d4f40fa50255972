"""Made records of a feed and a way to compare rows, for the tests."""


def call(i, **changes):
    """A sound call record; ``...`` leaves a field out."""
    record = {
        "event_id": f"cdr-{i:05d}",
        "source": "cdr-simulator",
        "event_time": f"2026-01-01T00:00:{i:02d}+00:00",
        "caller_id": "+1-555-1000",
        "callee_id": "+1-555-2000",
        "duration_sec": 60 + i,
        "network_type": "5g",
        "status": "ok",
    }
    return {k: v for k, v in (record | changes).items() if v is not ...}


def reading(i, **changes):
    """A sound telemetry reading."""
    record = {
        "metric_id": f"met-{i:05d}",
        "source": "metrics-simulator",
        "event_time": f"2026-01-01T00:00:{i:02d}+00:00",
        "throughput_rps": 300.5 + i,
        "consumer_lag": 3,
        "latency_ms": 140,
        "null_ratio": 0.01,
    }
    return {k: v for k, v in (record | changes).items() if v is not ...}


def drifted():
    """Twelve calls and eight readings with the faults of a drifting feed."""
    late = {"is_late_event": True}
    calls = [
        call(1), call(1), call(2), call(2),
        call(3, duration_sec=-1, roaming_flag=True), call(3, duration_sec=-1, roaming_flag=True),
        call(4, **late), call(5, **late), call(5, **late),
        call(6, event_id=None), call(7),
        call(8, callee_id=..., callee_identifier="+1-555-2468", **late),
    ]
    readings = [
        reading(1, **late), reading(2), reading(3, pipeline_region="us-east"),
        reading(4, consumer_lag=-3), reading(5, null_ratio=None, **late), reading(6, **late),
        reading(7), reading(8, consumer_lag=-3),
    ]
    return calls + readings


def rows(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in chosen.collect()), key=str)
