from ticklake.sources import normalize


def rows_of(spark, *frames):
    table = spark.createDataFrame([(v, raw, 7, 8, i) for i, (v, raw) in enumerate(frames)], "venue string, raw string, recv_ns long, mono_ns long, arrival_seq long")
    return [{k: v for k, v in r.asDict(recursive=True).items() if v is not None} for r in normalized(table)]


def normalized(table):
    return normalize.normalized(table).orderBy("seq").collect()


COMMON = {"local_receive_ts_ns": 7, "local_receive_mono_ns": 8}


def test_first_venue(spark):
    got = rows_of(
        spark,
        ("bybit", '{"topic":"orderbook.50.BTCUSDT","type":"snapshot","ts":5,"cts":4,"data":{"s":"btcusdt","b":[["1","2"]],"a":[],"u":7,"seq":9}}'),
        ("bybit", '{"topic":"orderbook.50.BTCUSDT","type":"delta","ts":5,"data":{"s":"BTCUSDT","b":[["1","2"]],"u":1}}'),
        ("bybit", '{"topic":"orderbook.50.BTCUSDT","type":"delta","ts":5,"data":{"s":"BTCUSDT","a":[["1","0"]],"u":8}}'),
        ("bybit", '{"topic":"allLiquidation.A","ts":5,"data":{"s":"A","S":"Buy","T":3,"v":"1","p":"2"}}'),
        ("bybit", '{"topic":"publicTrade.A","ts":5,"data":[{"s":"A","S":"Buy","T":0,"v":"1","p":"2"},{"s":"A","S":"none","T":3}]}'),
        ("bybit", '{"topic":"tickers.a","type":"Delta","ts":5,"cs":2,"data":{"symbol":"a","lastPrice":"","fundingRate":"0.1","nextFundingTime":"77"}}'),
        ("bybit", '{"topic":"kline.60.A","ts":5,"data":[{"start":1,"end":2,"open":"1","high":"2","low":"0","close":"1","volume":"3","turnover":"4","confirm":true}]}'),
    )
    ns = 1_000_000
    same = COMMON | {"venue": "bybit", "exchange_system_ts_ns": 5 * ns}
    book = same | {"symbol": "BTCUSDT", "depth": 50, "first_update_id": 0}
    assert got == [
        book | {"seq": 0, "kind": "orderbook_snapshot", "exchange_engine_ts_ns": 4 * ns, "bids": [["1", "2"]], "asks": [], "update_id": 7, "cross_sequence": 9, "restart_snapshot": False},
        book | {"seq": 1, "kind": "orderbook_snapshot", "exchange_engine_ts_ns": 0, "bids": [["1", "2"]], "asks": [], "update_id": 1, "cross_sequence": 0, "restart_snapshot": True},
        book | {"seq": 2, "kind": "orderbook_delta", "exchange_engine_ts_ns": 0, "bids": [], "asks": [["1", "0"]], "update_id": 8, "cross_sequence": 0, "restart_snapshot": False},
        same | {"seq": 3, "symbol": "A", "kind": "liquidation", "exchange_ts_ns": 3 * ns, "position_side": "Buy", "qty": 1.0, "bankruptcy_price": 2.0},
        same | {"seq": 4, "symbol": "A", "kind": "public_trade", "exchange_ts_ns": 5 * ns, "trade_id": "", "price": 2.0, "qty": 1.0, "side": "Buy"},
        same | {"seq": 5, "symbol": "A", "kind": "ticker", "message_type": "delta", "cross_sequence": 2, "values": {"funding_rate": 0.1, "next_funding_time_ms": 77.0}},
        same | {"seq": 6, "symbol": "A", "kind": "kline", "interval": "1h", "start_ms": 1, "end_ms": 2, "open": 1.0, "high": 2.0, "low": 0.0, "close": 1.0, "volume": 3.0, "turnover": 4.0, "confirmed": True},
    ]


def test_second_venue(spark):
    got = rows_of(
        spark,
        ("binance", '{"stream":"a@bookTicker","data":{"s":"a","b":"1","B":"2","a":"","A":"3","u":8,"E":1,"T":2}}'),
        ("binance", '{"stream":"a@depth20@100ms","data":{"s":"a","b":[["1","2"]],"a":[],"u":8,"E":1,"T":2,"U":3,"pu":2}}'),
        ("binance", '{"stream":"a@depth@100ms","data":{"s":"a","b":[],"a":[["1","2"]],"u":8,"E":1,"T":2,"U":3,"pu":2}}'),
        ("binance", '{"stream":"a@trade","data":{"s":"a","E":1,"T":0,"t":5,"p":"1","q":"2","m":true}}'),
        ("binance", '{"stream":"a@trade","data":{"s":"a","E":1,"T":0,"t":6,"p":"1","q":"2","m":true,"X":"NA"}}'),
        ("binance", '{"stream":"a@markPrice@1s","data":{"s":"a","E":1,"p":"1","i":"x","r":"","T":0}}'),
        ("binance", '{"stream":"a@ticker","data":{"s":"a","E":1,"c":"1","q":"5","v":"6","P":"50"}}'),
        ("binance", '{"stream":"!forceOrder@arr","data":[{"E":1,"o":{"s":"a","S":"SELL","q":"1","p":"2","T":3}},{"E":1,"o":{"s":"a","S":"x","q":"1","p":"2"}}]}'),
        ("binance", '{"stream":"a@kline_1h","data":{"s":"a","E":1,"k":{"t":1,"T":2,"o":"1","h":"2","l":"0","c":"1","v":"1","q":"2","x":true}}}'),
    )
    ns = 1_000_000
    same = COMMON | {"venue": "binance", "symbol": "A", "exchange_system_ts_ns": ns}
    book = same | {"exchange_engine_ts_ns": 2 * ns, "update_id": 8}
    ids = {"first_update_id": 3, "previous_update_id": 2}
    assert got == [
        book | {"seq": 0, "kind": "orderbook_snapshot", "depth": 1, "bids": [["1", "2"]], "asks": []},
        book | ids | {"seq": 1, "kind": "orderbook_snapshot", "depth": 20, "bids": [["1", "2"]], "asks": []},
        book | ids | {"seq": 2, "kind": "orderbook_delta", "depth": 1000, "bids": [], "asks": [["1", "2"]]},
        same | {"seq": 3, "kind": "public_trade", "exchange_ts_ns": ns, "trade_id": "5", "price": 1.0, "qty": 2.0, "side": "Sell"},
        same | {"seq": 5, "kind": "ticker", "message_type": "delta", "values": {"mark_price": 1.0, "next_funding_time_ms": 0.0}},
        same | {"seq": 6, "kind": "ticker", "message_type": "delta", "values": {"last_price": 1.0, "turnover_24h": 5.0, "volume_24h": 6.0, "price_change_24h_pct": 0.5}},
        same | {"seq": 7, "kind": "liquidation", "exchange_ts_ns": 3 * ns, "position_side": "Buy", "qty": 1.0, "bankruptcy_price": 2.0},
        same | {"seq": 8, "kind": "kline", "interval": "1h", "start_ms": 1, "end_ms": 2, "open": 1.0, "high": 2.0, "low": 0.0, "close": 1.0, "volume": 1.0, "turnover": 2.0, "confirmed": True},
    ]


def test_frames_without_rows(spark):
    assert not rows_of(
        spark, ("bybit", '{"op":"pong"}'), ("bybit", "torn{"), ("bybit", None), ("bybit", "[]"), ("bybit", '{"topic":"publicTrade.A","data":null}'), ("bybit", '{"topic":"tickers.A","data":"x"}'),
        ("bybit", '{"topic":"orderbook","data":{}}'), ("bybit", '{"topic":"kline.60","data":[{"start":1}]}'), ("binance", '{"stream":"a@depth@500ms","data":{"s":"a"}}'),
        ("binance", '{"stream":"a@kline_1h","data":{"s":"a"}}'), ("binance", '{"data":{}}'), (None, '{"topic":"tickers.A"}'),
    )
