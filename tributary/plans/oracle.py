"""The derived tables once more in plain SQL, for an independent engine to check against."""

from __future__ import annotations

AS_OF = "1706659200000"

CTES = {
    "raw0": """SELECT event_id, user_id, event_type, value, ts,
        epoch_us(ts)//1000 AS ts_ms, epoch_us(ts)//1000000 AS ts_s,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') AS iso,
        CASE user_id % 4 WHEN 0 THEN 'prod' WHEN 1 THEN 'stg' WHEN 2 THEN 'dev' ELSE 'lab' END || '-mc-' || (user_id % 3) AS cluster_id,
        CASE WHEN event_id % 101 = 0 THEN '' ELSE 'tenant-' || user_id END AS namespace,
        CASE event_type WHEN 'signup' THEN 'oauth-server' WHEN 'purchase' THEN 'kube-apiserver' WHEN 'error' THEN 'kube-scheduler'
            WHEN 'click' THEN 'openshift-apiserver' ELSE 'kube-controller-manager' END AS application
        FROM events""",
    "raw": """SELECT event_id, user_id, value, ts_ms, ts_s, iso, cluster_id, namespace, application,
        application || '-' || (user_id % 5) AS pod_name,
        ts_ms + 45000 AS ingest_ms, event_id AS line_no,
        cluster_id || '/' || namespace || '/' || application || '/' || application || '-' || (user_id % 5) || '/'
            || strftime(ts, '%Y%m') || '-' || (event_id % 2) || CASE WHEN event_id % 103 = 0 THEN '.json' ELSE '.json.gz' END AS object_key,
        CASE WHEN event_id % 53 = 0 THEN 'plain message ' || event_id
             WHEN event_id % 59 = 0 THEN '{"ts": "oops ' || event_id
             ELSE CASE event_id % 8
                WHEN 0 THEN '{"ts":"' || iso || 'Z","level":"info","msg":"m' || event_id || '"}'
                WHEN 1 THEN '{"ts":' || ts_s || ',"level":"info"}'
                WHEN 2 THEN '{"ts":' || ts_ms || ',"level":"warn"}'
                WHEN 3 THEN '{"time":"' || iso || 'Z","message":"m' || event_id || '"}'
                WHEN 4 THEN iso || 'Z direct ' || event_id
                WHEN 5 THEN 'time="' || iso || 'Z" level=info msg="m' || event_id || '"'
                WHEN 6 THEN 'I' || strftime(ts, '%m%d %H:%M:%S.%f') || ' 1 controller.go:231] m' || event_id
                ELSE strftime(ts, '%Y/%m/%d %H:%M:%S') || ' m' || event_id END END AS message
        FROM raw0""",
    "pods": """SELECT event_id, message,
        CASE WHEN event_id % 41 <> 0 THEN ingest_ms END AS ts_in_ms,
        CASE WHEN event_id % 43 <> 0 THEN namespace END AS pod_namespace,
        CASE WHEN event_id % 47 <> 0 THEN pod_name END AS pod,
        CASE WHEN event_id % 37 = 0 THEN NULL ELSE application END AS app_label,
        CASE WHEN user_id % 3 = 0 THEN 'false' ELSE 'true' END AS hosted,
        CASE WHEN event_id % 31 <> 0 THEN cluster_id END AS cluster
        FROM raw""",
    "stored": """SELECT object_key, line_no, CASE event_id % 20
        WHEN 0 THEN '{"timestamp":"' || iso || 'Z","level":"a<b","k":' || event_id || ',"cluster_id":"c","kubernetes":{"a":1}}'
        WHEN 1 THEN '[{"message":"a' || event_id || '","timestamp":' || ts_s || '},{"message":{"id":' || event_id || '},"timestamp":' || ts_ms || '},5]'
        WHEN 2 THEN '"just text ' || event_id || '"'
        WHEN 3 THEN '{"message": "x' || event_id
        WHEN 4 THEN '   '
        WHEN 5 THEN '{"message":"z' || event_id || '","timestamp":0}'
        WHEN 6 THEN '{"message":"n' || event_id || '"}'
        WHEN 7 THEN '{"message":"b' || event_id || '","timestamp":"' || CASE WHEN event_id % 40 = 7 THEN 'bad' ELSE iso || 'Z\\n' END || '"}'
        WHEN 8 THEN '{"message":null,"timestamp":"' || iso || 'Z"}'
        WHEN 9 THEN '{"message":' || CASE WHEN event_id % 40 = 9 THEN '[1,"two"]'
            ELSE '{"a":[1e3,-1e-7,1e21,2.50,0.000001,123456789.125,12345678901234567890],"b 1.50":"1.50' || chr(8232) || chr(8233) || '"}' END || ',"timestamp":' || ts_s || '.5}'
        ELSE '{"cluster_id":"' || cluster_id || '","message":"m' || event_id || ' é<>","timestamp":"' || iso || 'Z"}' END AS line
        FROM raw""",
    # Records of the stored lines: json_valid keeps whole JSON values only.
    "parsed": """SELECT object_key, line_no, line, json_valid(line) AS ok FROM stored WHERE regexp_matches(line, '\\S')""",
    "records": """SELECT object_key, line_no, 0 AS item_no, line::JSON AS rec FROM parsed WHERE ok AND line NOT LIKE '[%'
        UNION ALL
        SELECT object_key, line_no, i - 1 AS item_no, json_extract(line::JSON, '$[' || (i - 1) || ']') AS rec
        FROM (SELECT *, unnest(range(1, 1 + json_array_length(line::JSON)::BIGINT)) AS i FROM parsed WHERE ok AND line LIKE '[%')""",
    "ev": """SELECT object_key, line_no, item_no::INTEGER AS item_no,
        CASE json_type(rec, '$.timestamp')
            WHEN 'VARCHAR' THEN COALESCE(CASE WHEN regexp_full_match(rec->>'$.timestamp', '\\d{4}-\\d{2}-\\d{2}T\\d{2}:\\d{2}:\\d{2}([.,]\\d+)?(Z|[+-]\\d{2}:\\d{2})')
                THEN epoch_us(TRY_CAST(rec->>'$.timestamp' AS TIMESTAMPTZ))//1000 END, 1706659200000)
            WHEN 'UBIGINT' THEN CASE WHEN (rec->>'$.timestamp')::BIGINT > 1000000000000 THEN (rec->>'$.timestamp')::BIGINT ELSE (rec->>'$.timestamp')::BIGINT * 1000 END
            WHEN 'DOUBLE' THEN CASE WHEN (rec->>'$.timestamp')::DOUBLE > 1e12 THEN trunc((rec->>'$.timestamp')::DOUBLE)::BIGINT ELSE trunc((rec->>'$.timestamp')::DOUBLE * 1000)::BIGINT END
            ELSE 1706659200000 END AS event_ts_ms,
        CASE json_type(rec, '$.message') WHEN 'VARCHAR' THEN rec->>'$.message'
            ELSE replace(replace(replace(CASE WHEN json_exists(rec, '$.message.a') THEN '{"a":[1000,-1e-7,1e+21,2.5,0.000001,123456789.125,12345678901234567000],"b 1.50":"1.50\\u2028\\u2029"}'
                WHEN json_exists(rec, '$.message') THEN CAST(json_extract(rec, '$.message') AS VARCHAR)
                ELSE '{"k":' || CAST(json_extract(rec, '$.k') AS VARCHAR) || ',"level":' || CAST(json_extract(rec, '$.level') AS VARCHAR) || '}' END,
                '&', '\\u0026'), '<', '\\u003c'), '>', '\\u003e') END AS message
        FROM records WHERE json_type(rec) = 'OBJECT'""",
    "listing": """SELECT object_key, sum(strlen(message))::BIGINT AS size_bytes, max(ingest_ms) AS modified_ms, min(event_id) AS eid
        FROM raw GROUP BY object_key""",
    "info": """SELECT *, p[1] AS cluster_id, p[2] AS namespace, p[2] AS tenant_id, p[3] AS application, p[4] AS pod_name,
        CASE split_part(p[1], '-', 1) WHEN 'stg' THEN 'staging' WHEN 'dev' THEN 'development' ELSE 'production' END AS environment
        FROM (SELECT *, string_split(object_key, '/') AS p FROM listing)
        WHERE len(p) >= 5 AND trim(p[1]) <> '' AND trim(p[2]) <> '' AND trim(p[3]) <> '' AND trim(p[4]) <> ''""",
    "cfg0": """SELECT c_custkey AS k, unnest(['cloudwatch', 's3']) AS type FROM customer WHERE c_custkey % 12 <> 11""",
    "cfg": """SELECT k, 'tenant-' || k AS tenant_id, type,
        CASE k % 10 WHEN 1 THEN NULL WHEN 2 THEN false ELSE true END AS enabled,
        CASE k % 7 WHEN 1 THEN []::VARCHAR[] WHEN 2 THEN [''] WHEN 3 THEN ['kube-apiserver'] WHEN 4 THEN ['Kube-APIServer']
            WHEN 5 THEN ['oauth-server', 'kube-scheduler', 'custom-app-1'] END AS desired_logs,
        CASE k % 9 WHEN 0 THEN ['api', 'Authentication'] WHEN 1 THEN ['nosuch', 'SCHEDULER'] END AS groups,
        CASE WHEN k % 13 = 0 THEN 'bad region!' WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN '' ELSE 'us-east-1' END AS target_region,
        CASE WHEN type = 'cloudwatch' THEN CASE WHEN k % 17 = 3 THEN 'arn:bad:role' WHEN k % 19 = 4 THEN ''
            ELSE 'arn:aws:iam::' || lpad(k::VARCHAR, 12, '0') || ':role/LogDistributionRole' END END AS log_distribution_role_arn,
        CASE WHEN type = 'cloudwatch' THEN CASE WHEN k % 23 = 5 THEN '  ' ELSE '/aws/logs/tenant-' || k END END AS log_group_name,
        CASE WHEN type = 's3' THEN CASE WHEN k % 29 = 6 THEN NULL WHEN k % 31 = 7 THEN 'bad_bucket$' ELSE 'tenant-' || k || '-logs' END END AS bucket_name,
        CASE WHEN type = 's3' THEN CASE k % 4 WHEN 1 THEN '' WHEN 2 THEN 'custom/path' WHEN 3 THEN 'logs/' END END AS bucket_prefix,
        (CASE k % 11 WHEN 5 THEN 1706000000 WHEN 6 THEN 1800000000 END)::BIGINT AS ttl,
        (k + 1700000000) * 1000 AS created_ms
        FROM cfg0 WHERE NOT (k % 12 = 3 AND type = 's3') AND NOT (k % 12 = 4 AND type = 'cloudwatch')""",
    "live": """SELECT *, CASE type WHEN 'cloudwatch' THEN trim(COALESCE(log_distribution_role_arn, '')) = '' OR trim(COALESCE(log_group_name, '')) = ''
            ELSE trim(COALESCE(bucket_name, '')) = '' END AS bad
        FROM cfg WHERE COALESCE(enabled, false) AND (ttl IS NULL OR ttl > 1706659200)""",
    "routable": """SELECT * FROM live WHERE tenant_id NOT IN (SELECT tenant_id FROM live WHERE bad)""",
    "routed": """SELECT i.*, r.* EXCLUDE (tenant_id) FROM info i JOIN routable r USING (tenant_id)
        WHERE r.desired_logs IS NULL OR len(r.desired_logs) = 0 OR r.desired_logs = [''] OR list_contains(r.desired_logs, i.application)""",
    "msgs": """SELECT 'msg-' || eid || '-' || md5(object_key) AS message_id, eid, object_key,
        CASE WHEN eid % 29 = 0 THEN '' ELSE 'rh-' || eid END AS receipt_handle, (eid % 5)::INTEGER AS receive_count,
        modified_ms - CASE WHEN eid % 31 = 0 THEN 1300000000 ELSE 0 END AS sent_ms,
        modified_ms + (eid % 4) * 900000000 AS visible_ms,
        CASE WHEN eid % 7 = 0 THEN 'invalid json content' ELSE '{"Message":"' ||
          CASE WHEN eid % 13 = 0 THEN 'not json' WHEN eid % 19 = 0 THEN '{\\"Event\\":\\"test\\"}'
            ELSE '{\\"Records\\":[{\\"s3\\":{\\"bucket\\":{\\"name\\":\\"central-logs\\"},\\"object\\":{\\"key\\":\\"'
              || CASE WHEN eid % 17 = 0 THEN 'bad%zz/' || object_key ELSE replace(object_key, '-', '%2D') END || '\\"}}}'
              || CASE WHEN eid % 10 = 0 THEN ',{\\"s3\\":{\\"bucket\\":{\\"name\\":\\"central-logs\\"},\\"object\\":{\\"key\\":\\"invalid-key+format.json.gz\\"}}}'
                WHEN eid % 10 = 5 THEN ',{\\"s3\\":{\\"bucket\\":{\\"name\\":\\"central-logs\\"},\\"object\\":{\\"key\\":\\"bad%zz/second.json.gz\\"}}}'
                  || ',{\\"s3\\":{\\"bucket\\":{\\"name\\":\\"central-logs\\"},\\"object\\":{\\"key\\":\\"never-reached.json.gz\\"}}}' ELSE '' END
              || ']}' END
          || '"' || CASE WHEN eid % 11 = 0 THEN ',"processing_metadata":{"offset":' || (eid % 4) || ',"retry_count":' || (eid % 5) || '}'
                WHEN eid % 23 = 0 THEN ',"processing_metadata":"broken"' ELSE '' END || '}' END AS body
        FROM listing""",
    "opened": """SELECT *, TRY_CAST(body AS JSON) AS env FROM msgs""",
    "opened2": """SELECT *, TRY_CAST(env->>'$.Message' AS JSON) AS note, json_type(env, '$.processing_metadata') AS mt FROM opened""",
    "judged": """SELECT *, CASE WHEN env IS NULL THEN 'invalid_envelope' WHEN note IS NULL THEN 'invalid_notification'
            WHEN mt IS NOT NULL AND mt <> 'OBJECT' THEN 'invalid_metadata'
            END AS error_code,
        list_position(list_transform(json_extract_string(note, '$.Records[*].s3.object.key'), lambda k: regexp_matches(k, '%([^0-9A-Fa-f]|.[^0-9A-Fa-f])')), true) - 1 AS bad_at,
        CASE WHEN mt = 'OBJECT' THEN COALESCE((env->>'$.processing_metadata.offset')::BIGINT, 0) ELSE 0 END AS "offset",
        CASE WHEN mt = 'OBJECT' THEN COALESCE((env->>'$.processing_metadata.retry_count')::BIGINT, 0) ELSE 0 END AS retry_count
        FROM opened2""",
    "notes": """SELECT message_id, "offset", retry_count, error_code, NULL::INTEGER AS record_idx, NULL::VARCHAR AS bucket, NULL::VARCHAR AS object_key, eid
        FROM judged WHERE error_code IS NOT NULL OR COALESCE(json_array_length(note, '$.Records'), 0) = 0
        UNION ALL SELECT message_id, "offset", retry_count, 'invalid_escape', bad_at::INTEGER, NULL::VARCHAR, NULL::VARCHAR, eid FROM judged WHERE error_code IS NULL AND bad_at >= 0
        UNION ALL
        SELECT message_id, "offset", retry_count, NULL, i::INTEGER, note->>('$.Records[' || i || '].s3.bucket.name'),
            url_decode(replace(note->>('$.Records[' || i || '].s3.object.key'), '+', '%20')), eid
        FROM (SELECT *, unnest(range(0, CASE WHEN bad_at >= 0 THEN bad_at ELSE json_array_length(note, '$.Records')::BIGINT END)) AS i FROM judged WHERE error_code IS NULL)""",
}

# Which tables a table is built from.
NEEDS = {
    "raw": ["raw0"],
    "pods": ["raw"],
    "stored": ["raw"],
    "parsed": ["stored"],
    "records": ["parsed"],
    "ev": ["records"],
    "listing": ["raw"],
    "info": ["listing"],
    "cfg": ["cfg0"],
    "live": ["cfg"],
    "routable": ["live"],
    "routed": ["info", "routable"],
    "msgs": ["listing"],
    "opened": ["msgs"],
    "opened2": ["opened"],
    "judged": ["opened2"],
    "notes": ["judged"],
}


def oracle(body: str, *tables: str, recursive: bool = False, **extra: str) -> str:
    """SQL text: the needed derived tables, then extra named tables, then the query."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS.get(name, []):
            add(n)
        if name not in ordered:
            ordered.append(name)

    for t in tables:
        add(t)
    parts = [f"{n} AS ({CTES[n]})" for n in ordered] + [f"{n} AS ({sql})" for n, sql in extra.items()]
    head = f"WITH {'RECURSIVE ' if recursive else ''}{', '.join(parts)} " if parts else ""
    return head + body
