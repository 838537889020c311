"""Records in the format of the data contract, and helpers to build more."""

from __future__ import annotations

import json
from datetime import datetime

LOGIN_404 = (
    '{"time":"2024-03-17T21:05:09+07:00","ts":1710684309.4,"remote":"198.51.100.23",'
    '"host":"shop.test","hostname":"web1","method":"GET","path":"/account/cart","status":404,'
    '"bytes":12,"rt":0.007,"ua":"check/2.1","referer":"https://shop.test/"}'
)
API_502 = (
    '{"time":"2024-11-30T18:20:44+00:00","ts":1732990844.25,"remote":"203.0.113.9",'
    '"hostname":"web1","method":"GET","path":"/v2/quote","status":502,"bytes":318,"rt":0.004}'
)
REFUSED = (
    "2024/03/17 21:05:30 [error] 71#71: *4402 connect() failed (111: Connection refused) "
    'while connecting to upstream, client: 198.51.100.40, server: shop, request: "POST /v2/order '
    'HTTP/1.1", upstream: "http://10.9.8.7:9000/v2/order", host: "web1"'
)
NO_SERVER = (
    "2024/11/30 18:20:44 [error] 52#52: *93 connect() failed (111: Connection refused) "
    'while connecting to upstream, client: 203.0.113.9, server: , request: "GET /v2/quote '
    'HTTP/1.1", upstream: "http://127.0.0.1:7099/v2/quote", host: "localhost:9443"'
)
NOTICE = "2024/11/30 18:20:44 [notice] 9#9: reopening logs"


def request(time="2025-01-01T00:00:01+00:00", host="web1", ip="1.1.1.1", method="GET",
            path="/", status=200, rt=0.1, **extra):
    return json.dumps({"time": time, "remote": ip, "hostname": host, "method": method,
                       "path": path, "status": status, "bytes": 1, "rt": rt, **extra})


def at(second: int, minute: int = 0, hour: int = 0) -> str:
    return f"2025-01-01T{hour:02d}:{minute:02d}:{second:02d}+00:00"


def moment(text: str) -> datetime:
    return datetime.fromisoformat(text)


def lines(spark, values, column="value"):
    return spark.createDataFrame([(v,) for v in values], f"{column} string")
