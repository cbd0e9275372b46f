"""The labelled table of problem 5: lines of web pages by what they are, and pages composed of them.

The lines are the wording that web pages of any subject use, in three languages; ``{s}`` stands for
a site, ``{p}`` and ``{q}`` for persons, ``{t}`` and ``{u}`` for subjects, ``{n}`` and ``{m}`` for figures.
"""

from __future__ import annotations

import random

#: Kinds of furniture lines; what is not here is the article's.
FURNITURE_KINDS = ("menu", "consent", "byline", "counter", "contact", "legal", "share", "tags", "next", "advert")

LINES: dict[str, dict[str, list[str]]] = {
    "en": {
        "menu": [
            "Home", "News", "About us", "Contact us", "Sign in", "Log in", "Register", "Search", "Shop", "Video", "Photos", "Gallery", "Sport", "Business", "Health", "Conditions", "Nutrition", "Recipes", "Travel", "Careers", "Jobs", "Prices", "Services", "Our team", "Experts", "Doctors",
            "Medicines", "Questions", "FAQ", "Help", "Support", "Forum", "Blog", "Events", "Book an appointment", "Living", "Parents", "Family", "Weather", "Opinion", "Archive", "Sitemap", "Lifestyle", "Book now", "My account", "Topics", "Editor's corner", "A to Z",
        ],
        "consent": [
            "We use cookies to improve your experience. By continuing to use this site you agree to our use of cookies.", "{s} and its partners use cookies and similar technologies to measure traffic and remember your settings.", "This website stores cookies on your computer. Accept all or manage your preferences.",
            "{s} uses cookies to personalise content. [Accept] [Decline]", "Our partners store small text files on your device to analyse visits. Cookie settings. [Accept all] [Reject all]", "By scrolling this page or clicking OK you consent to cookies. Read our privacy policy.", "We rely on cookies so that the site works; see privacy options. [OK]",
        ],
        "byline": [
            "By {p}", "By {p}, photos by {q}", "Written by {p} and {q}", "Written by {p} | Reviewed by {q}", "Medically reviewed by Dr {p}", "Fact checked by {p}", "Text: {p} Photos: {q}", "Edited by {p}", "Author: {p}", "Reporter: {p}; editor: {q}", "Words by {p}. Review: {q}", "Photo: {p}", "Edited by the {s} desk",
            "Contributor: {p}", "Checked by {p}, {s} staff",
        ],
        "counter": ["{n} views", "{n} views | updated {m}/3/2021", "Last updated 12-3-20{m}", "Published on 4 May 20{m}, {n} reads", "Posted 20{m}-11-05 {m}:15", "Read {n} times, updated 20{m}/7/2", "{n} comments, {m} shares", "Updated: 20{m}-04-0{m}"],
        "contact": [
            "Call us: 000-{n}-{m}", "Hotline {n} {m} {n}", "Helpline: {n}-{m}, open on weekdays", "Tel: {n} {m}  Fax: {n} {m}", "Address: {n} Mill Lane, Harbour Town", "{n} Station Street, Old Quarter, North Town", "Email: info@{s}.example", "Advertising enquiries: ads@{s}.example", "Advertise with us: sales@{s}.example",
            "Customer service: {n}-{m}", "{n} River Row, Floor {m}", "Editorial office: {n} Park Avenue", "Contact the newsroom: desk@{s}.example",
        ],
        "legal": [
            "© 20{m} {s}. All rights reserved.", "Copyright © {s} 20{m}", "All content is protected by copyright and may not be reproduced without permission.", "No part of this site may be copied or reused without written consent of {s}.", "The information on {s} is for general information only and does not replace professional advice.",
            "Content on this website is not medical advice.", "{s} is a registered publisher, licence no. {n}.", "{s} is registered under number {n}", "Terms of use | Privacy policy | Accessibility", "Privacy - Terms - Cookies - {s}", "Disclaimer | Imprint | Privacy notice", "Reproduction of material from {s} without permission is prohibited.",
            "Terms and conditions apply. {s} 20{m}",
        ],
        "share": [
            "Share this article", "Share on social networks", "Share this story by email or link", "Share this page", "Follow us on social media", "Follow {s} on all channels", "Like {n} Share {m} Comment {n}", "Print | Email | Save", "Print this page", "Send this article to a friend", "Save this story for later",
            "Subscribe to our newsletter", "Sign up for the {s} newsletter", "Get our daily briefing in your inbox every morning", "Download the {s} app", "Get the free app for faster access", "Copy link", "Tap to copy link", "Was this article helpful? Yes No", "Did you find this page useful? Pass it on!", "Tell your friends!", "Join our channel",
            "Leave a comment", "Comments ({n})", "Report an error", "Rate this page", "Enjoyed this? Share it with a friend", "Subscribe now",
        ],
        "tags": ["Tags: {t}, {u}", "Tags: {t}", "Topics: {t}, {u}", "Filed under: {t}", "Filed under {t}, {u}", "Keywords: {t}, {u}", "Categories: {t} | {u}", "Labels: {t}"],
        "next": ["Read next: {t}", "Read more: {t} / {u}", "More on {t}", "More about {t} / {u}", "Related: {t} / {u}", "Related articles", "See also: {t}", "You may also like", "Most read", "Latest news", "Recommended for you", "Next article: {t}", "← {h} | {h} →", "Previous: {h}  Next: {h}", "Up next: {t}"],
        "advert": ["Advertisement", "Advertisement - continue reading below", "Sponsored content", "Story continues after the advertisement", "Promoted", "Ad"],
        "headline": [
            "{n} facts about {t} and {u}", "Why {t} matters to {u}", "{t}: why beginners notice {u}", "What to know about {t}", "How to prepare {t} for {u}", "The causes of {t} among {u}", "{t} among {u}", "Who is at risk of {t}", "A short guide to {t}", "When to ask for help with {t}", "Common myths about {t} among {u}", "Choosing {t} for {u}", "Treating {t} among {u}", "Preventing {t} among {u}",
        ],
        "heading": ["Causes of {t}", "## Outlook", "## Living with {t}", "Diet in {t}", "**Myths about {t}**", "### How {t} is diagnosed ({u})", "Exercise for {t} ({u})", "{n}. Treatment of {t}", "# {h}", "What you need", "Method", "Side effects", "**Getting there**", "## When to see a doctor"],
        "prose": [
            "The first step is to rest and drink plenty of water before taking anything for {t}.", "In 20{m} the clinic treated more than {n} people with {t}, most of them mild cases.", "Do not stop the course as soon as {t} fades.", "According to {p} of the institute, about {n} percent of cases are linked to {u}.", "Whisk the eggs with the flour and let the batter stand for {n} minutes.",
            "The village lies at the end of a valley, and the bus takes about {n} minutes from the station.", "Interest rates rose by {m} points, and many households felt the change at once.", "Many people with {t} overlook {u} during the first weeks.", "Small studies suggest that walking every day helped within {n} weeks, but larger trials are needed.",
            "Doctors advise patients to keep a diary and note each episode of {t}.", "\"Is it safe to stop?\" many readers ask.", "She told us: \"The pain came back at night.\"", "Compared with the control group, the score fell by {m} points.", "It was not clear whether {u} played a part.", "Can {t} be combined with {u}?", "Write to the author at {p}@mail.example with questions.",
            "The leaflet says that the product is for information only, and that nobody should rely on it alone.", "Readers may subscribe to the channel or share the report with a friend, but few of them do.", "The page was last updated years ago, as the museum's archivist noted in the printed edition.", "Always wash your hands before touching {u}!", "The committee published its {t} report in the spring.",
        ],
        "item": ["A dry cough at night", "Dizziness on standing, most mornings", "Two cups of flour", "Swelling of the hands, even at rest", "A red rash after meals", "Loss of appetite in the early stage", "Warm clothes and good shoes", "One tin of tomatoes, drained", "Trembling hands that worsen slowly", "Poor sleep when the weather changes", "Sudden weight loss", "Blurred vision despite treatment", "Numb feet after long sitting", "Hoarse voice for several weeks", "Mild fever in the evening", "Yellow skin on one side only", "Chest pain on exertion", "Night sweats that come back every autumn", "A stiff neck and shoulders", "Nausea after a new tablet", "Dull pain in the stomach", "Itching that disturbs sleep", "Leg cramps during the night", "Tiredness without a clear reason", "A fast heartbeat", "Swollen joints", "Dry mouth, even after drinking", "Shortness of breath on stairs", "Painful swallowing", "Bloating with mild discomfort", "A pinch of salt", "Passport and tickets", "Sharp knife, cutting board", "Half a litre of milk"],
        "row": ["| {t} | {n} mg | {m} |", "|---|---|---|", "| Name | Portion | Energy |", "| {u} | {n} g | {m} kcal |", "| Dose | Days | Notes |"],
        "subject": ["gout", "bread baking", "back pain", "winter travel", "asthma", "migraine", "garden soil", "high blood pressure", "savings accounts", "older adults", "children", "school meals", "type {n} diabetes", "hiking boots", "pregnant women", "walnuts", "green tea", "office workers", "insomnia", "fruit juice"],
    },
    "vi": {
        "menu": [
            "Trang chủ", "Tin tức", "Giới thiệu", "Liên hệ", "Đăng nhập", "Đăng ký", "Tìm kiếm", "Cửa hàng", "Video", "Thư viện ảnh", "Thể thao", "Kinh doanh", "Sức khỏe", "Bệnh học", "Dinh dưỡng", "Công thức nấu ăn", "Du lịch", "Tuyển dụng", "Bảng giá", "Dịch vụ", "Đội ngũ", "Chuyên gia", "Bác sĩ", "Tủ thuốc",
            "Hỏi đáp", "Trợ giúp", "Diễn đàn", "Sự kiện", "Đặt lịch khám", "Đời sống", "Mẹ và bé", "Gia đình", "Thời tiết", "Góc chuyên gia", "Tra cứu", "Sống khỏe", "Giáo dục", "Pháp luật", "Công nghệ", "Tài khoản", "Chủ đề",
        ],
        "consent": [
            "Chúng tôi sử dụng cookie để cải thiện trải nghiệm của bạn. Tiếp tục sử dụng trang nghĩa là bạn đồng ý.", "{s} và các đối tác dùng cookie để đo lường lượng truy cập và ghi nhớ cài đặt.", "Trang web này lưu tệp cookie trên thiết bị của bạn. [Đồng ý] [Từ chối]", "{s} dùng tệp cookie để cá nhân hóa nội dung. Bấm Chấp nhận để tiếp tục.",
            "Bằng việc tiếp tục xem trang, bạn chấp thuận chính sách cookie. Xem tùy chọn quyền riêng tư.", "Trang {s} lưu cookie nhằm phân tích lượt truy cập. [Chấp nhận tất cả] [Tùy chọn]",
        ],
        "byline": [
            "Bài: {p}", "Bài: {p} - Ảnh: {q}", "Tác giả: {p}", "Bài và ảnh: {p}", "Theo {p}", "Theo {p} ({q} tổng hợp)", "Tham vấn y khoa: BS. {p}", "Tham vấn chuyên môn: {p}; biên tập: {q}", "Người viết: {p} | Kiểm duyệt: {q}", "Nguồn: {p}", "Ảnh: {p}", "Biên tập: {p}", "Chịu trách nhiệm nội dung: {p}", "{p} (biên soạn)", "Theo {p} ({q} biên soạn)",
        ],
        "counter": ["Lượt xem: {n}", "Lượt xem: {n} - Cập nhật {m}/3/20{m}", "Cập nhật lần cuối: {m}/3/20{m}", "{n} lượt đọc, cập nhật 20{m}/7/2", "Đăng ngày {m}/11/20{m} lúc {m}:15", "{n} bình luận", "Ngày đăng: {m}-03-20{m}"],
        "contact": [
            "Đường dây nóng: {n} {m} {n}", "Hotline: {n}.{m}", "Điện thoại: {n} {m} - Fax: {n}", "Địa chỉ: {n} đường Hoa Sữa, TP. Biển Xanh", "Địa chỉ: số {n}, phố Cổ, Q. {m}", "Liên hệ quảng cáo: ads@{s}.example", "Email: toasoan@{s}.example", "Chăm sóc khách hàng: {n} {m}", "Tòa soạn: {n} đường Bến Sông", "Liên hệ quảng cáo: {n} {m}",
        ],
        "legal": [
            "© 20{m} {s}. Mọi quyền được bảo lưu.", "Bản quyền © {s} 20{m}", "© Bản quyền thuộc {s}. Giữ toàn quyền đối với nội dung.", "Cấm sao chép dưới mọi hình thức nếu không có sự đồng ý bằng văn bản của {s}.", "Nội dung trên {s} chỉ mang tính tham khảo, không thay thế tư vấn của bác sĩ.", "Thông tin trên trang chỉ để tham khảo.",
            "Giấy phép số {n}/GP-TTĐT cấp ngày {m}/3/20{m}", "Giấy phép thiết lập trang thông tin điện tử số {n}/GP", "Điều khoản sử dụng | Chính sách bảo mật | Liên hệ", "Điều khoản - Quyền riêng tư - {s}", "Ghi rõ nguồn {s} khi phát hành lại thông tin.",
        ],
        "share": [
            "Chia sẻ bài viết", "Chia sẻ lên mạng xã hội", "Chia sẻ bài viết qua thư điện tử", "Theo dõi chúng tôi trên mạng xã hội", "Theo dõi {s} trên các kênh", "Thích {n} Chia sẻ {m} Bình luận {n}", "In bài | Lưu bài | Gửi mail", "In bài viết - Lưu bài - Gửi góp ý", "In trang", "Gửi bài cho bạn bè", "Đăng ký nhận bản tin", "Đăng ký nhận tin mới của {s} mỗi sáng",
            "Tải ứng dụng {s}", "Tải ứng dụng để đặt lịch nhanh hơn", "Sao chép liên kết", "Bài viết có hữu ích với bạn không? Có Không", "Bạn thấy bài viết hữu ích? Hãy chia sẻ với mọi người!", "Tham gia kênh của chúng tôi", "Gửi bình luận", "Bình luận ({n})", "Báo lỗi nội dung", "Đánh giá bài viết",
        ],
        "tags": ["Thẻ: {t}, {u}", "Từ khóa: {t}, {u}", "Từ khóa: {t}", "Chủ đề: {t}", "Tags: {t}, {u}", "Chuyên mục: {t}, {u}", "Thẻ: {t}"],
        "next": ["Đọc tiếp: {t}", "Xem thêm: {t} / {u}", "Xem thêm về {t} / {u}", "Tin liên quan: {t} / {u}", "Bài liên quan", "Có thể bạn quan tâm", "Đọc nhiều nhất", "Tin mới nhất", "Bài tiếp theo: {t}", "← {h} | {h} →", "Bài trước: {h}  Bài sau: {h}", "Đọc thêm: {t} / {u}"],
        "advert": ["Quảng cáo", "Quảng cáo - đọc tiếp bên dưới", "Nội dung tài trợ", "Quảng cáo - nội dung do nhãn hàng tài trợ", "Tin tài trợ"],
        "headline": [
            "{n} điều cần biết về {t} và {u}", "Vì sao {t} quan trọng với {u}", "{t}: vì sao {u} cần chú ý?", "Cách phòng ngừa {t} ở {u}", "Nguyên nhân gây {t} ở {u}", "Chẩn đoán {t} ở {u}", "Những hiểu lầm về {t} ở {u}", "Khi nào cần khám {t} ở {u}", "Cẩm nang {t} cho {u}", "Điều trị {t} ở {u}", "Chế độ ăn cho người {t} ở {u}", "Đối tượng dễ mắc {t} ở {u}",
        ],
        "heading": ["Nguyên nhân gây {t}", "## Tiên lượng", "## Điều trị {t}", "Cách phòng ngừa {t} ({u})", "**Những hiểu lầm về {t}**", "### Chẩn đoán {t}", "Bài tập hỗ trợ {t} ({u})", "{n}. Dấu hiệu của {t}", "# {h}", "Nguyên liệu", "Cách làm", "**Đường đi**", "## Khi nào cần khám"],
        "prose": [
            "Điều quan trọng nhất là nghỉ ngơi, sau đó mới cân nhắc dùng thuốc trị {t}.", "Trong năm 20{m}, bệnh viện tiếp nhận hơn {n} ca {t} ở mức độ nhẹ.", "Không nên ngừng thuốc khi {t} vừa thuyên giảm.", "Theo {p} ở viện nghiên cứu, khoảng {n} phần trăm trường hợp có liên quan đến {u}.", "Đánh đều trứng với bột rồi để bột nghỉ {n} phút.",
            "Ngôi làng nằm ở cuối thung lũng, xe buýt đi từ ga mất khoảng {n} phút.", "Lãi suất tăng thêm {m} điểm và nhiều gia đình cảm nhận được ngay.", "Nhiều người bị {t} thường bỏ qua dấu hiệu {u} trong vài tuần đầu.", "Một số nghiên cứu nhỏ cho thấy đi bộ mỗi ngày giúp hồi phục tốt hơn sau {n} tuần.", "Bác sĩ khuyên người bệnh nên ghi nhật ký và báo lại mỗi lần {t}.",
            "\"Có thể ngừng thuốc được không?\" là câu hỏi thường gặp.", "Chị ấy kể: \"Đêm nào tôi cũng đau.\"", "So với nhóm chứng, điểm số giảm {m} điểm.", "Có nên dùng {t} cùng {u} không?", "Bạn đọc có thể gửi thư cho tác giả theo địa chỉ {p}@thu.example để hỏi thêm.", "Tờ rơi chỉ để tham khảo, nhưng nhiều người vẫn tin theo và chia sẻ với bạn bè.", "Hãy rửa tay trước khi chạm vào {u}!", "Ủy ban đã công bố báo cáo về {t} hồi đầu năm.", "Người đọc có thể đăng ký theo dõi hoặc lưu lại bài để xem sau, song ít người làm vậy.",
        ],
        "item": ["Ho khan về đêm", "Chóng mặt khi đứng dậy, thường gặp buổi sáng", "Hai chén bột mì", "Sưng tay kể cả lúc nghỉ ngơi", "Phát ban đỏ sau bữa ăn", "Ăn không ngon ở giai đoạn đầu", "Áo ấm và giày tốt", "Một hộp cà chua, để ráo nước", "Run tay nặng dần", "Mất ngủ khi thay đổi thời tiết", "Sụt cân nhanh", "Mờ mắt không đáp ứng với thuốc", "Tê chân sau khi ngồi lâu", "Khàn giọng kéo dài vài tuần", "Sốt nhẹ về chiều", "Vàng da chỉ một bên", "Đau ngực khi gắng sức", "Đổ mồ hôi đêm, tái phát theo mùa", "Cứng cổ và vai", "Buồn nôn sau khi dùng thuốc mới", "Đau âm ỉ vùng bụng", "Ngứa gây mất ngủ", "Chuột rút ban đêm", "Mệt mỏi không rõ nguyên nhân", "Tim đập nhanh", "Sưng đau khớp kèm sốt nhẹ", "Khô miệng dù đã uống nước", "Khó thở khi leo cầu thang", "Đau rát khi nuốt", "Chướng hơi kèm khó chịu nhẹ", "Một nhúm muối", "Hộ chiếu và vé", "Dao sắc, thớt gỗ", "Nửa lít sữa"],
        "row": ["| {t} | {n} mg | {m} |", "|---|---|---|", "| Tên | Khẩu phần | Năng lượng |", "| {u} | {n} g | {m} kcal |", "| Thuốc | Liều dùng | Số ngày |"],
        "subject": ["gút", "làm bánh mì", "đau lưng", "du lịch mùa đông", "hen phế quản", "đau nửa đầu", "đất vườn", "tăng huyết áp", "tài khoản tiết kiệm", "người cao tuổi", "trẻ nhỏ", "bữa ăn học đường", "đái tháo đường", "giày leo núi", "phụ nữ mang thai", "hạt óc chó", "trà xanh", "nhân viên văn phòng", "mất ngủ", "nước ép trái cây"],
    },
    "zh": {
        "menu": [
            "首页", "新闻", "资讯", "关于我们", "联系我们", "登录", "注册", "搜索", "商城", "视频", "图库", "图片", "体育", "财经", "健康", "疾病百科", "营养", "菜谱", "旅游", "招聘", "价格表", "服务", "团队", "专家", "医生", "药品", "问答", "帮助", "论坛", "活动", "预约挂号", "生活", "母婴", "家庭", "天气", "专栏", "查询", "教育", "科技", "我的账户", "话题", "健康生活", "关于本站",
        ],
        "consent": [
            "我们使用Cookie来改善您的体验。继续浏览即表示您同意。", "{s}及合作伙伴使用Cookie技术统计访问量并记住您的设置。", "本网站会在您的设备上保存Cookie文件。【接受】【拒绝】", "{s}使用Cookie以提供个性化内容。点击“接受”继续访问。", "继续使用本站即表示您接受隐私设置，可随时更改。", "{s}会在您的设备上保存小型文本文件用于分析访问。【同意】【更多选项】",
        ],
        "byline": ["作者：{p}", "作者 {p}｜编辑 {q}", "撰文：{p} 摄影：{q}", "来源：{p}", "来源：{p} 编辑：{q}", "责任编辑：{p}", "审核：{p}", "文／{p} 图／{q}", "记者 {p} 编辑 {q}", "校对：{p}", "作者 {p}｜核对 {q}", "撰文：{p} 审校：{q}"],
        "counter": ["阅读 {n} 次", "阅读 {n} 更新于20{m}年3月{m}日", "更新时间：20{m}-03-{m}", "发布于20{m}年11月5日 {m}:15", "浏览量：{n}", "{n}人看过 {m}条评论", "发表时间：20{m}年7月2日"],
        "contact": ["客服热线：{n}-{m}", "电话：{n}-{m} 传真：{n}", "服务热线 {n}{m}", "地址：海滨市春风路{n}号", "地址：老城区文化街{n}号{m}楼", "广告合作：ads@{s}.example", "邮箱：info@{s}.example", "投稿邮箱：desk@{s}.example", "商务合作：{n}-{m}", "编辑部地址：和平路{n}号"],
        "legal": [
            "© 20{m} {s} 版权所有", "版权所有 © {s} 未经授权不得转载", "未经书面许可，不得复制或转载本站内容。", "{s}所载内容仅供参考，不能代替专业人士的意见。", "本站信息仅供参考，不作为诊疗依据。", "备案号：{n}号", "网站备案编号：XK-{n}", "经营许可证编号：{n}", "免责声明 | 隐私政策 | 使用条款", "隐私条款 | 版权声明 | {s}", "转载请注明来源：{s}",
        ],
        "share": [
            "分享本文", "分享到：朋友圈 微博 邮箱", "扫码分享文章", "扫一扫关注我们", "关注{s}公众号", "关注{s}官方频道", "点赞 {n} 分享 {m} 评论 {n}", "打印 | 收藏 | 推荐", "打印本页 | 发送给朋友", "收藏本文", "订阅我们的简报", "订阅{s}每日早报", "下载{s}客户端", "下载手机应用，预约更方便", "复制链接", "这篇文章对您有帮助吗？有 没有", "觉得不错？分享给家人和朋友吧！", "加入我们的频道", "发表评论", "评论（{n}）", "我要纠错", "为本文评分", "觉得有用？转发给更多人！",
        ],
        "tags": ["标签：{t}，{u}", "标签：{t}, {u}", "关键词：{t}, {u}", "关键词：{t}", "归类：{t}, {u}", "话题：{t}", "标签：{t}", "分类：{t}, {u}"],
        "next": ["相关阅读：{t} / {u}", "延伸阅读：{t}", "推荐阅读：{t} / {u}", "更多：{t} / {u}", "更多关于{t}的内容", "猜你喜欢", "热门文章", "最新资讯", "为您推荐", "上一篇：{h} 下一篇：{h}", "下一篇：{h}", "← {h} | {h} →"],
        "advert": ["广告", "广告 · 请继续阅读下文", "赞助内容", "广告 · 正文继续", "推广"],
        "headline": ["关于{t}与{u}的{n}个要点", "为什么{u}要注意{t}", "{t}患者为何会担心（{u}篇）", "怎样预防{t}：写给{u}", "诊断{t}：写给{u}", "{t}的常见误区：写给{u}", "护理{t}：写给{u}", "饮食与{t}：写给{u}", "何时需要为{t}就医", "{u}如何选择{t}", "{t}之预后：写给{u}", "易患{t}的人群：写给{u}"],
        "heading": ["{t}的原因", "## 预后如何", "## 护理{t}", "常用药物与{t}（{u}）", "**{t}的误区**", "### 诊断{t}", "锻炼与{t}（{u}）", "{n}. 治疗{t}", "# {h}", "材料", "做法", "**交通**", "## 何时就医"],
        "prose": [
            "首先要做的是多休息、多喝水，之后再考虑用药治疗{t}。", "20{m}年，医院收治了{n}多名轻度{t}患者。", "症状刚减轻时，不要自行停药。", "{p}主任表示，约{n}%的病例与{u}有关。", "把鸡蛋和面粉搅匀，静置{n}分钟。", "村子在山谷尽头，从车站坐车大约{n}分钟。", "利率上升了{m}个点，许多家庭马上感受到了变化。", "不少{t}患者在最初几周会忽视{u}。",
            "一些小型研究发现，每天散步有助于在{n}周内恢复。", "医生建议患者记日记，并记下每次{t}发作的时间。", "“能停药吗？”许多读者这样问。", "她说：“夜里疼得厉害。”", "与对照组相比，评分下降了{m}分。", "{t}期间可以吃{u}吗？", "来信请寄{p}@mail.example。", "传单上写着仅供参考，可还是有人相信并转发给朋友。", "接触{u}之前请务必洗手！", "委员会在年初公布了关于{t}的报告。", "读者可以订阅频道或收藏文章，但这样做的人不多。",
        ],
        "item": ["夜间干咳", "起立时头晕，多见于早晨", "两杯面粉", "双手肿胀，休息时也有", "饭后出现红疹", "早期食欲不振", "保暖衣物和好鞋", "一罐番茄，沥干", "双手颤抖，逐渐加重", "天气变化时失眠", "体重骤降", "视力模糊，对药物无反应", "久坐后双脚麻木", "声音嘶哑，持续数周", "傍晚低热", "皮肤发黄，仅见于一侧", "活动后胸痛", "夜间盗汗，随季节复发", "颈肩僵硬", "服用新药后恶心", "腹部隐痛", "瘙痒影响睡眠", "夜间小腿抽筋", "不明原因的乏力", "心跳加快", "关节肿痛，伴有低热", "口干，喝水后仍有", "上楼时气短", "吞咽疼痛", "腹胀，伴有轻微不适", "一小撮盐", "护照和车票", "锋利的刀和砧板", "半升牛奶"],
        "row": ["| {t} | {n} mg | {m} |", "|---|---|---|", "| 名称 | 份量 | 热量 |", "| {u} | {n} g | {m} kcal |", "| 药物 | 用量 | 天数 |"],
        "subject": ["痛风", "面包烘焙", "腰痛", "冬季旅行", "哮喘", "偏头痛", "园土", "高血压", "储蓄账户", "老年人", "儿童", "学校午餐", "糖尿病", "登山鞋", "孕妇", "核桃", "绿茶", "办公室职员", "失眠", "果汁"],
    },
}

_BULLETS = ("- ", "* ", "• ", "» ", "▶ ", "› ")
_PATHS = (" > ", " » ", " / ", "›", " | ")
SITES = ("Harbour Post", "Northwind", "Daily Lantern", "Oakhill Review", "Riverton", "Bluebird Care")
_PERSONS = {"en": ("Ann Carter", "J. Holt", "Miriam Stone", "Peter Vale"), "vi": ("Nguyễn Minh", "Lê Hoa", "Trần Quốc Bảo", "Phạm Thu"), "zh": ("王晓明", "李静", "陈一帆", "赵宁")}


def compose(rng: random.Random, lines: dict[str, dict[str, list[str]]] = LINES) -> list[tuple[str, str]]:
    """A page as ``(kind, line)``; a blank line has the kind ``""``."""
    lang = rng.choice(sorted(lines))
    have = lines[lang]
    site = rng.choice(SITES)

    def fill(line: str) -> str:
        if "{h}" in line:
            return fill(line.replace("{h}", rng.choice(have["headline"]), 1)) if line.count("{h}") < 2 else fill(line.replace("{h}", fill(rng.choice(have["headline"])), 1))
        figures = lambda: rng.choice((rng.randint(2, 9), rng.randint(10, 99), rng.randint(100, 999)))
        out = line.replace("{s}", site).replace("{p}", rng.choice(_PERSONS[lang])).replace("{q}", rng.choice(_PERSONS[lang]))
        out = out.replace("{t}", rng.choice(have["subject"])).replace("{u}", rng.choice(have["subject"]))
        while "{n}" in out or "{m}" in out:
            out = out.replace("{n}", str(figures()), 1).replace("{m}", str(rng.randint(10, 29)), 1)
        return out[:1].upper() + out[1:]

    page: list[tuple[str, str]] = []

    def put(kind: str, text: str | None = None) -> None:
        page.append((kind, fill(text if text is not None else rng.choice(have[kind]))))

    def blank(share: float = 0.5) -> None:
        if rng.random() < share:
            page.append(("", ""))

    def menu() -> None:
        names = rng.sample(have["menu"], rng.randint(3, 8))
        form = rng.random()
        if form < 0.3:
            bullet = rng.choice(_BULLETS)
            page.extend(("menu", bullet + x) for x in names)
        elif form < 0.5:
            page.extend(("menu", f"[{x}](/{rng.randrange(9999):x})") for x in names)
        elif form < 0.65:
            page.extend(("menu", x) for x in names)
        else:
            page.append(("menu", rng.choice((" | ", " • ", " / ", "  ", "\t", " · ", "|", " » ")).join(names)))

    def others() -> None:
        """A list of other articles."""
        bullet = rng.choice((*_BULLETS, "", ""))
        if rng.random() < 0.6:
            put("next")
        linked = rng.random() < 0.3
        for _ in range(rng.randint(2, 6)):
            line = fill(rng.choice(have["headline"]))
            page.append(("next", bullet + (f"[{line}](/{rng.randrange(99999):x})" if linked else line)))

    def prose() -> None:
        space = "" if lang == "zh" else " "
        link = f"[{rng.choice(have['subject'])}](/{rng.randrange(99999):x})" if rng.random() < 0.05 else ""
        page.append(("prose", link + space.join(fill(rng.choice(have["prose"])) for _ in range(rng.choice((1, 2, 3, 4, 5, 8))))))

    def listing() -> None:
        bullet = rng.choice((*_BULLETS[:3], "{}. ", "{}) ", "", ""))
        for k in range(rng.randint(20, 80) if rng.random() < 0.12 else rng.randint(2, 6)):
            page.append(("item", bullet.format(k + 1) + rng.choice(have["item"])))

    if rng.random() < 0.12:
        # Only a piece of an article.
        for part in rng.choice(((listing,), (prose,), (prose, prose), (prose, listing), (listing, prose), (lambda: put("heading"), listing), (lambda: put("heading"), prose))):
            part()
        return page
    if rng.random() < 0.6:
        menu()
    if rng.random() < 0.6:
        put("consent")
    blank(0.3)
    if rng.random() < 0.35:
        page.append(("menu", rng.choice(_PATHS).join((have["menu"][0], rng.choice(have["menu"]), fill(rng.choice(have["subject"])), fill(rng.choice(have["item"]))))))
    if rng.random() < 0.9:
        put("headline")
    for kind in rng.sample(("byline", "counter", "byline"), rng.randint(0, 3)):
        put(kind)
    for _ in range(rng.choice((1, 1, 2, 3, 4, 5, 6))):
        blank(0.6)
        if rng.random() < 0.6:
            put("heading")
        for _ in range(rng.choice((1, 1, 2, 3))):
            prose()
            if rng.random() < 0.06:
                put(rng.choice(FURNITURE_KINDS[1:]))
        form = rng.random()
        if form < 0.4:
            listing()
        elif form < 0.5:
            for _ in range(rng.randint(2, 4)):
                put("row")
        if rng.random() < 0.08:
            others()
            blank()
    blank()
    for kind in rng.sample(("tags", "share", "next", "share", "contact", "legal", "byline", "advert"), rng.randint(0, 5)):
        put(kind)
    if rng.random() < 0.4:
        others()
    if rng.random() < 0.3:
        menu()
    for kind in rng.sample(("contact", "legal", "share", "contact", "legal"), rng.randint(0, 4)):
        put(kind)
    return page
