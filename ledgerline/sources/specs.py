"""Column specs for shredding the landed change documents.

A spec entry is ``name[=json.path]:TYPE``; without ``=path`` the path is the name. TYPE words are
the ones the models use: S (string), JSONB (kept as VARIANT), BOOL, INT, NUMERIC(15,2) (which is
decimal(38,9): precision and scale are dropped), DOUBLE PRECISION and TS (epoch milliseconds).
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Field:
    name: str
    path: str
    dtype: str


def parse_spec(text: str) -> list[Field]:
    out = []
    for tok in text.split():
        name_path, dtype = tok.rsplit(":", 1)
        name, _, path = name_path.partition("=")
        out.append(Field(name, path or name, dtype))
    return out


# ---------------------------------------------------------------------------------------------
# FIXED VALUES: the staging column lists of the three landed document types, in the order the
# source models declare them. They must equal the reference's names, paths and types.
# ---------------------------------------------------------------------------------------------

TRANSACTIONS_SPEC = """
__v:INT id=_id.$oid:S _ver:NUMERIC(15,2) amount:NUMERIC(15,2) app_url:S approval_code:S
auto_paid:BOOL auto_reconcile_dest_acc_info:JSONB bank_code:S bank_payment_url:S
bank_terminal_id:S bank_type:S bill_info:JSONB billpay_data:JSONB business_entity_id:S
card_info:JSONB card_input_retries:NUMERIC(15,2) cashback_amt:NUMERIC(15,2)
cashback_request_amt:NUMERIC(15,2) create_payment_token:BOOL created_at:TS created_by:S
currency:S customer_account:S customer_address:S customer_email:S customer_mobile_number:S
customer_name:S description:S destination_account:S ecopay_extra_data:S extra_data:JSONB
exchange_currencies:JSONB expires_date:S fv_payment_transid:S generator_partner_code:S
initial_amount:NUMERIC(15,2) installment_info:JSONB ipn_url:S is_forced_manually_reconcile:BOOL
is_keep_input:BOOL is_partner_processing:BOOL is_reconciled:BOOL is_refund:BOOL is_send_otp:BOOL
match_bank_info:JSONB mcc_group:S mcc_group_snapshot:JSONB merchant_app_url:S merchant_code:S
merchant_name:S merchant_user_id:S order_id:S original_amount:NUMERIC(15,2) otp_transid:S
paid_at:TS parent_merchant_code:S partmer_transid_old:S partner_code:S partner_payment_at:TS
partner_profile:S partner_profile_snapshot:JSONB partner_transid:S partner_transid_old:S
paylater_info:JSONB payment_channel:S payment_link_reqid:S payment_link_transid:S
payment_service:S payment_source:S payment_url:S platform:S pos_transaction:S prev_status:S
processing_at:TS provider_code:S purpose_of_transaction:S qrcode:S qrcode_mapping_code:S
qrcode_payment_type:S reason:S reconcile_acc:JSONB reconcile_account:JSONB reconcile_data:JSONB
reconcile_dest_acc_info:JSONB reconcile_list:JSONB redirect_url:S refund_transid_list:JSONB
refunded_amt:NUMERIC(15,2) refunded_request_amt:NUMERIC(15,2) req_eco_transfer_id:S
req_eco_transfer_to_merchant_id:S req_time:TS request_create_at:TS request_create_from:S
res_eco_transfer_id:S res_eco_transfer_to_merchant_id:S result_code:S service_type:S
source_account:S source_issuer:S status:S status_user_fee:BOOL step:JSONB steps:JSONB
store_code:S store_label:S sub_bank_type:S sub_payment_channel:S synched_at:TS terminal_code:S
terminal_id:S terminal_label:S tokenization=tokenization.$oid:S total_cashback_fee:NUMERIC(15,2)
total_fee:DOUBLE_PRECISION total_refund_fee:NUMERIC(15,2) total_user_fee:NUMERIC(15,2)
transaction_fee_snapshot:JSONB transid:S updatedAt:TS updated_at:TS updated_by:S
manager_team_id=manager_team_id.$oid:S settlement_at:TS user_fee:NUMERIC(15,2)
user_fee_snapshot:JSONB
"""

STORES_SPEC = """
id=_id.$oid:S __v:S approved_at:TS bank_account_name:S bank_account_number:S bank_code:S
bank_integrated:S bank_name:S branch_name:S business_name:S category_code:S code:S
contract_codes:JSONB created_at:TS created_by=created_by.$oid:S crm_org_id:S eco_wallet_holder:S
ecom_config:JSONB ewallet_account:S expires_payment_link_time:S histories:JSONB index:INT
integrated_partner:JSONB ipn_url:S is_allowed_create_payment_link:BOOL is_default:BOOL
is_supplier:BOOL location:JSONB location_v2:JSONB manager_phone:S
manager_team_id=manager_team_id.$oid:S mapping_at:TS merchant_code:S my_qrcode_config:JSONB
name:S note:S notification_channel_config:JSONB notification_config:JSONB
payment_link_config:JSONB payment_methods:JSONB payment_type:S phone:S pos_config:JSONB
pure_name:S qrcode:S qrcode_list:JSONB qrcode_mapping_code:S qrcode_mapping_code_list:JSONB
reasons:JSONB reconcile_method:JSONB refund_ipn_url:S rejected_at:TS rejected_count:INT
representative_user_info:JSONB request_create_from:S sale_info:JSONB secret_key:S
softPOS_config:JSONB status:S steps:JSONB tax_code:S terminal_name:S transaction_config:JSONB
updated_at:TS updated_by=updated_by.$oid:S updatedAt:TS user_fee_configs:JSONB zalo:JSONB
"""

USERS_SPEC = """
__v:INT id=_id.$oid:S account_id:S area_group:S area_group_info:JSONB area_groups:JSONB
area_groups_info:JSONB avatar:S birthday=birthday.$date:TS code:S company_id=company.$oid:S
company_info:JSONB created_at=created_at.$date:TS created_by:S
created_by_area_group=created_by_area_group.$oid:S created_by_group=created_by_group.$oid:S
created_by_user=created_by_user.$oid:S created_by_user_info:JSONB default_distributor:S
default_distributor_info:JSONB device_id:S direct_manager=direct_manager.$oid:S
direct_manager_info:JSONB distributor_id=distributor.$oid:S distributor_info:JSONB
distributors:JSONB distributors_info:JSONB end_date=end_date.$date:TS email:S friends:JSONB
group_id=group.$oid:S group_chats:JSONB group_info:JSONB groups:JSONB groups_info:JSONB
histories_role_changed:JSONB history_resource:S is_calculation_salary:BOOL is_not_save_info:BOOL
is_synchronized:BOOL keycloak_id:S kpi_target:S kpi_targets:JSONB kpi_targets_info:S
last_sync_at=last_sync_at.$date:TS location:JSONB name:S new_area_group=new_area_group.$oid:S
new_area_group_info:JSONB new_area_groups:JSONB new_area_groups_info:JSONB new_location:JSONB
new_rsd_area_group=new_rsd_area_group.$oid:S new_rsd_area_group_info:JSONB
new_rsm_area_group=new_rsm_area_group.$oid:S new_rsm_area_group_info:JSONB notify:JSONB
password:S phone:S phone_contact:S reference:JSONB role_groups:JSONB role_groups_info:JSONB
roles:JSONB roles_info:JSONB route=route.$oid:S route_info:JSONB routes:JSONB routes_future:JSONB
routes_future_info:JSONB routes_info:JSONB rsd_area_group=rsd_area_group.$oid:S
rsd_area_group_info:JSONB rsm_area_group=rsm_area_group.$oid:S rsm_area_group_info:JSONB sex:S
sso_code:S sso_id:S sso_roles:JSONB start_date=start_date.$date:TS status:S
synchronized_at=synchronized_at.$date:TS third_party_user_code:S title:S
updated_at=updated_at.$date:TS updated_by:S updated_by_user=updated_by_user.$oid:S
updated_by_user_info:JSONB user=user.$oid:S user_info:JSONB
"""

# ---------------------------------------------------------------------------------------------

TRANSACTIONS = parse_spec(TRANSACTIONS_SPEC)
STORES = parse_spec(STORES_SPEC)
USERS = parse_spec(USERS_SPEC)

SPECS = {"transactions": TRANSACTIONS, "stores": STORES, "users": USERS}

# Envelope columns every staged table carries after the payload columns.
STAGING_ENVELOPE = ["op", "ts_ms", "json_inserted_at", "inserted_at"]


def core_columns(table: str) -> list[str]:
    """Columns of the latest-per-key table built from a staged table (``op`` and
    ``json_inserted_at`` are dropped; stores keep the staging stamp as ``source_inserted_at``)."""
    cols = [f.name for f in SPECS[table]] + ["ts_ms"]
    if table == "stores":
        cols.append("source_inserted_at")
    return cols + ["inserted_at"]
