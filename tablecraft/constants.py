"""Fixed values of the two data models. Order and spelling matter for results."""

# Loan columns removed before modelling.
LOAN_ID_COLUMNS = ["id", "issue_d", "url"]
LOAN_MINOR_COLUMNS = [
    "emp_title", "title", "zip_code", "earliest_cr_line", "last_pymnt_d",
    "next_pymnt_d", "last_credit_pull_d", "policy_code",
]
LOAN_CURRENT_COLUMNS = [
    "out_prncp", "out_prncp_inv", "total_pymnt", "total_pymnt_inv", "total_rec_prncp",
    "total_rec_int", "total_rec_late_fee", "recoveries", "collection_recovery_fee",
    "last_pymnt_amnt", "collections_12_mths_ex_med", "acc_now_delinq", "tot_coll_amt",
    "tot_cur_bal", "total_rev_hi_lim",
]
LOAN_UNUSED_COLUMNS = [
    "fico_range_low", "last_fico_range_high", "hardship_flag", "debt_settlement_flag",
    "loan_status",
]

# Loan columns converted to 32-bit floats.
LOAN_FLOAT_COLUMNS = [
    "loan_amnt", "funded_amnt", "funded_amnt_inv", "int_rate", "installment", "annual_inc",
    "dti", "delinq_2yrs", "inq_last_6mths", "open_acc", "pub_rec", "revol_bal", "revol_util",
    "total_acc", "fico_range_high", "last_fico_range_low", "open_acc_6m", "open_act_il",
    "open_il_12m", "open_il_24m", "mths_since_rcnt_il", "total_bal_il", "il_util",
    "open_rv_12m", "open_rv_24m", "max_bal_bc", "all_util", "inq_fi", "total_cu_tl",
    "avg_cur_bal", "bc_util",
]

# Categorical loan columns and how each one is encoded.
LOAN_INDEXED_COLUMNS = ["term", "initial_list_status", "application_type", "pymnt_plan"]
LOAN_ONE_HOT_COLUMNS = [
    "grade", "sub_grade", "home_ownership", "verification_status", "purpose", "addr_state",
]

# Statuses.
PAID_STATUS = "Fully Paid"
CHARGED_OFF_STATUS = "Charged Off"
SETTLED_STATUSES = [PAID_STATUS, CHARGED_OFF_STATUS]
DEFAULT_STATUSES = [
    "Default", "Charged Off", "Late (31-120 days)", "Late (16-30 days)",
    "Does not meet the credit policy. Status:Charged Off",
]

# Years of employment behind each text level; any other text counts as 0.
EMPLOYMENT_YEARS = {
    "< 1 year": 0, "1 year": 1, "2 years": 2, "3 years": 3, "4 years": 4, "5 years": 5,
    "6 years": 6, "7 years": 7, "8 years": 8, "9 years": 9, "10+ years": 10,
}

# Study parameters.
SPARSE_FRACTION = 0.5
LABEL_COLUMN = "ClassLable"
WEIGHT_COLUMN = "weightColumn"
SPLIT_SEED = 1395
TRAIN_SHARE = 0.7
IMPORTANCE_FLOOR = 0.0001

# Shop event types and report sizes.
VIEW, CART, PURCHASE = "view", "cart", "purchase"
BUYING_EVENTS = [CART, PURCHASE]
TOP_BRANDS = 50
TOP_PURCHASE_BRANDS = 70

# Most levels of a column that may become indicator columns of their own.
ONE_HOT_LEVELS = 1000
