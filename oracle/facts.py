"""DuckDB CTEs: events -> blocks, receipt_actions, execution_outcomes."""

V = "v.hos.test"
VOTE = "vote.hos.test"

FACT_CTES = r"""
ev0 AS (
  SELECT event_id, ts, user_id, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         event_id // 10 AS b, event_id // 100 AS q, event_id % 100 AS r,
         'u' || CAST(user_id AS VARCHAR) || '.near' AS acct,
         CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) || '0000000000000000000000' AS amt,
         epoch_us(ts) * 1000 AS ns,
         min(ts) OVER (PARTITION BY event_id // 10) AS block_ts
  FROM events
),
ev1 AS (
  SELECT *,
    'u' || CAST((user_id + k) % 15 AS VARCHAR) || '.near' AS dlg,
    1000 + b + b // 50 AS height,
    CASE WHEN b = 0 THEN 999 ELSE 1000 + (b - 1) + (b - 1) // 50 END AS prev_height,
    user_id % 4 AS shard,
    CASE
      WHEN r = 0 THEN 'create_proposal'
      WHEN r = 1 AND q % 4 <> 3 THEN 'approve_proposal'
      WHEN r = 1 THEN 'reject_proposal'
      WHEN r = 2 THEN 'on_get_snapshot'
      WHEN r = 5 AND q % 10 = 3 THEN 'approve_proposal'
      WHEN r = 5 AND q % 10 = 7 THEN 'reject_proposal'
      WHEN event_id = 3 THEN 'new'
      WHEN event_type = 'click' THEN 'vote'
      WHEN event_type = 'signup' AND event_id % 2 = 0 THEN 'on_lockup_deployed'
      WHEN event_type = 'signup' THEN 'storage_deposit'
      WHEN event_type = 'view' AND k % 3 = 0 THEN 'undelegate'
      WHEN event_type = 'view' THEN 'delegate_all'
      WHEN event_type = 'purchase' THEN (['lock_near', 'begin_unlock_near', 'lock_pending_near', 'unstake',
            'unstake_all', 'withdraw_from_staking_pool', 'withdraw_all_from_staking_pool',
            'on_lockup_update'])[k % 8 + 1]
      ELSE 'other'
    END AS method_name
  FROM ev0
),
ev2 AS (
  SELECT *,
    CASE
      WHEN method_name IN ('lock_near', 'begin_unlock_near', 'lock_pending_near', 'unstake', 'unstake_all',
                           'withdraw_from_staking_pool', 'withdraw_all_from_staking_pool')
        THEN 'lk' || CAST(user_id AS VARCHAR) || '.v.hos.test'
      WHEN method_name = 'vote' AND event_id % 59 = 58 THEN 'VOTE.HOS.TEST'
      WHEN method_name = 'other' AND k % 4 = 1 THEN 'V.hos.test'
      WHEN method_name IN ('vote', 'create_proposal', 'approve_proposal', 'reject_proposal', 'on_get_snapshot')
        THEN 'vote.hos.test'
      WHEN method_name = 'other' AND k % 2 = 0 THEN 'x' || CAST(user_id AS VARCHAR) || '.elsewhere.test'
      ELSE 'v.hos.test'
    END AS receiver_id,
    CASE WHEN method_name IN ('on_lockup_deployed', 'on_get_snapshot', 'on_lockup_update') THEN 'v.hos.test'
         ELSE acct END AS predecessor_id,
    CASE WHEN method_name = 'new' THEN 'v.hos.test' ELSE acct END AS signer_account_id,
    CASE
      WHEN method_name = 'approve_proposal' THEN 'SuccessReceiptId'
      WHEN r = 2 AND q % 10 = 9 THEN 'Failure'
      WHEN r <= 3 THEN 'SuccessValue'
      WHEN k % 13 = 0 THEN 'Failure'
      WHEN k % 17 = 1 THEN 'Unknown'
      WHEN method_name = 'vote' THEN 'SuccessValue'
      WHEN event_id % 2 = 0 THEN 'SuccessReceiptId'
      ELSE 'SuccessValue'
    END AS status,
    NOT (r > 3 AND event_id % 97 = 96) AS has_outcome
  FROM ev1
),
ev3 AS (
  SELECT *,
    CASE
      WHEN r > 3 AND event_id % 89 = 88 THEN 'not json'
      WHEN r > 3 AND event_id % 83 = 82 THEN '{"error":"boom","proposal_id":1}'
      WHEN method_name = 'create_proposal' THEN
        '{"metadata":{"title":"P' || q || '","description":"d' || q || '","link":"http://x/' || q || '"}}'
      WHEN method_name IN ('approve_proposal', 'reject_proposal') THEN '{"proposal_id":' || q || '}'
      WHEN method_name = 'vote' THEN
        '{"proposal_id":' || greatest(q - k % 3, 0) || ',"vote":' || (k % 3)
        || ',"v_account":{"V0":{"balance":{"near_balance":"' || amt || '","extra_venear_balance":"0"},'
        || '"delegation":{"account_id":"' || dlg || '"},'
        || '"delegated_balance":{"near_balance":"0","extra_venear_balance":"0"}}}}'
      WHEN method_name = 'on_lockup_deployed' THEN '{"account_id":"' || acct || '","lockup_deposit":"' || amt || '"}'
      WHEN method_name = 'storage_deposit' THEN '{"account_id":"' || acct || '"}'
      WHEN method_name = 'delegate_all' THEN '{"receiver_id":"' || dlg || '"}'
      WHEN method_name IN ('lock_near', 'begin_unlock_near', 'lock_pending_near', 'unstake',
                           'withdraw_from_staking_pool') THEN '{"amount":"' || CASE WHEN event_id % 67 = 66 THEN '1.5' WHEN event_id % 61 = 60 THEN repeat('9', 39) ELSE amt END || '"}'
      WHEN method_name = 'new' THEN
        '{"venear_growth_config":{"annual_growth_rate_ns":{"numerator":"1902587519026","denominator":"1000000000000000000000000000000"}}}'
      ELSE '{}'
    END AS plain_args,
    CASE WHEN r > 3 AND event_id % 5 = 4 THEN 1 + event_id % 2 ELSE 0 END AS n_before,
    CASE WHEN method_name = 'on_lockup_update' AND event_id % 3 = 0 THEN 2 ELSE 1 END AS n_calls,
    'EVENT_JSON:{"standard":"venear","version":"1.0.0","event":"' AS evp,
    '","data":[{"owner_id":"' AS own
  FROM ev2
),
ev AS (
  SELECT *,
    CASE WHEN r > 3 AND event_id % 79 = 78 THEN plain_args || '] junk'
         WHEN r > 3 AND method_name = 'vote' AND event_id % 73 = 72 THEN '{"proposal_id":999999,' || substr(plain_args, 2)
         ELSE plain_args END AS args_text,
    (r > 3 AND event_id % 71 = 70) AS bad_utf8,
    CASE
      WHEN r > 3 AND event_id % 53 = 52 THEN NULL
      WHEN status IN ('Failure', 'Unknown') THEN []::VARCHAR[]
      WHEN method_name = 'create_proposal' THEN [evp || 'create_proposal","data":[{"proposal_id":' || q || '}]}']
      WHEN method_name = 'vote' THEN [evp || 'add_vote","data":[{"account_balance":"' || amt || '"}]}']
      WHEN method_name = 'on_lockup_deployed' THEN
        [evp || 'lockup_deployed","data":[{"account_id":"' || acct || '","locked_near_balance":null}]}']
      WHEN method_name = 'storage_deposit' THEN [evp || 'ft_mint' || own || acct || '","amount":"' || amt || '"}]}']
      WHEN method_name = 'lock_near' THEN
        [evp || 'lock_near","data":[{"account_id":"' || acct || '","locked_near_balance":"' || amt || '"}]}']
      WHEN method_name = 'on_lockup_update' THEN
        [evp || 'lockup_update","data":[{"account_id":"' || acct || '","locked_near_balance":"' || amt
             || '","timestamp":"' || ns || '"}]}',
         evp || CASE WHEN event_id % 2 = 0 THEN 'ft_mint' ELSE 'ft_burn' END || own || acct
             || '","amount":"' || amt || '"}]}']
      WHEN method_name = 'delegate_all' THEN
        [evp || 'ft_burn' || own || acct || '","amount":"' || amt || '"}]}',
         evp || 'ft_mint' || own || dlg || '","amount":"' || amt || '"}]}']
      WHEN method_name = 'undelegate' AND event_id % 2 = 0 THEN
        [evp || 'ft_burn' || own || dlg || '","amount":"' || amt || '"}]}',
         evp || 'ft_mint' || own || acct || '","amount":"' || amt || '"}]}',
         'Transfer done']
      WHEN method_name = 'undelegate' THEN
        [evp || 'ft_burn' || own || dlg || '","amount":"' || amt || '"}]}',
         evp || 'ft_mint' || own || acct || '","amount":"' || amt || '"}]}']
      WHEN method_name IN ('unstake_all', 'withdraw_all_from_staking_pool') THEN
        ['Withdrawing all', evp || 'withdraw","data":[{"amount":"' || amt || '"}]}']
      WHEN method_name IN ('unstake', 'withdraw_from_staking_pool') THEN ['Unstaking ' || amt]
      ELSE []::VARCHAR[]
    END AS logs,
    CASE
      WHEN status = 'Failure' THEN '{"error":"Smart contract panicked","status_type":"Failure"}'
      WHEN status = 'Unknown' THEN '{"status_type":"Unknown"}'
      WHEN method_name = 'approve_proposal' THEN '{"receipt_id":"r' || (event_id + 1) || '","status_type":"SuccessReceiptId"}'
      WHEN status = 'SuccessReceiptId' THEN '{"receipt_id":"c' || event_id || '","status_type":"SuccessReceiptId"}'
      WHEN method_name = 'on_get_snapshot' THEN
        '{"snapshot_and_state":{"total_venear":"' || amt || '"},"voting_duration_ns":"604800000000000","voting_start_time_ns":"'
        || ns || '","creation_time_ns":"' || (ns - 3600000000000) || '"}'
    END AS results_json,
    CASE
      WHEN method_name = 'approve_proposal' THEN ['r' || (event_id + 1)]
      WHEN status = 'SuccessReceiptId' THEN ['c' || event_id]
      ELSE []::VARCHAR[]
    END AS outcome_receipt_ids,
    'r' || event_id AS receipt_id,
    md5(CAST(height AS VARCHAR)) AS block_hash,
    CASE WHEN shard = 3 THEN '' ELSE md5(height || '/' || shard) END AS chunk_hash,
    'node' || (height % 5) || '.test' AS author,
    (lower(receiver_id) LIKE '%.hos.test' OR lower(predecessor_id) LIKE '%.hos.test') AS is_contract
  FROM ev3
),
receipt_actions AS (
  SELECT receipt_id || '-' || action_index AS id, height AS block_height, receipt_id, signer_account_id,
         'ed25519:' || md5(signer_account_id) AS signer_public_key, '100000000' AS gas_price,
         'FunctionCall' AS action_kind, predecessor_id, receiver_id, block_hash, chunk_hash, author, method_name,
         CAST(10000000000000 * (1 + k % 3) AS BIGINT) AS gas,
         CASE WHEN method_name = 'storage_deposit' THEN amt ELSE '0' END AS deposit,
         base64(CASE WHEN bad_utf8 THEN from_hex('FFFEFD') ELSE encode(args_text) END) AS args_base64,
         CASE WHEN NOT bad_utf8 AND json_valid(args_text) THEN args_text ELSE '{"value":"invalid json"}' END AS args_json,
         CAST(action_index AS INTEGER) AS action_index, block_ts AS block_timestamp
  FROM (SELECT *, unnest(range(n_before, n_before + n_calls)) AS action_index FROM ev WHERE is_contract)
),
execution_outcomes AS (
  SELECT receipt_id, height AS block_height, block_hash, chunk_hash, CAST(shard AS VARCHAR) AS shard_id,
         CAST(2400000000000 + CAST(k AS BIGINT) * 1000000000 AS BIGINT) AS gas_burnt,
         CAST(2400000000000 + CAST(k AS BIGINT) * 1000000000 AS DOUBLE) AS gas_used,
         CAST(2400000000000 + CAST(k AS BIGINT) * 1000000000 AS DOUBLE) * 1e8 / 1e24 AS tokens_burnt,
         receiver_id AS executor_account_id, status, outcome_receipt_ids, block_hash AS executed_in_block_hash,
         logs, results_json, block_ts AS block_timestamp
  FROM ev WHERE is_contract AND has_outcome
),
blocks AS (
  SELECT height, md5(CAST(height AS VARCHAR)) AS hash,
         CASE WHEN b % 97 = 96 THEN md5('x') ELSE md5(CAST(prev_height AS VARCHAR)) END AS prev_hash,
         'node' || (height % 5) || '.test' AS author, min(ts) AS "timestamp",
         '100000000' AS gas_price, '1000000000000000000000000000000000' AS total_supply
  FROM ev1 GROUP BY b, height, prev_height
)"""
